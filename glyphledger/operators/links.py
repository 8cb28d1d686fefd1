"""Links in text: extraction, following, dedup and the reverse index."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphledger.functions.text import (
    extension,
    find_all,
    normalize_url,
    resolve_path,
    strip,
    strip_comments,
)
from glyphledger.operators.ordering import side_by_side


def _hosts(hosts: Iterable[str]) -> str:
    return "|".join(h.replace(".", r"\.") for h in hosts)


def link_patterns(cdn_hosts: Sequence[str], static_hosts: Sequence[str]) -> list[str]:
    """The link forms of hosted icon fonts for given hosts. The path forms."""
    cdn, static = _hosts(cdn_hosts), _hosts(static_hosts)
    return [
        rf"(?:https?:)?//(?:{cdn})/t/(?:c/)?font_\d+_[a-zA-Z0-9]+\.(?:css|js)",
        rf"(?:https?:)?//(?:{static})/(?:ali-)?iconfont/font_\d+_[a-zA-Z0-9]+\.(?:css|eot|woff2?|ttf|svg)",
        rf"(?:https?:)?//(?:{static})/iconfont/\d+/css/symbols\.css",
        rf"(?:https?:)?//(?:{static})/[\w./-]*iconfont[\w./-]*\.css",
        rf"(?:https?:)?//(?:{static})/[\w./-]*font_\d+_[a-zA-Z0-9]+\.(?:eot|woff2?|ttf)",
    ]


# Import statements, quoted local stylesheets, url(...), numbered fonts and
# the two template placeholders.
IMPORT_PATTERN = r"""@import\s+(?:url\(\s*)?['"]?([^'")\s;]+{kw}[^'")\s;]*)['"]?\s*\)?\s*;"""
LOCAL_PATTERN = r"""['"]([\w./-]*{kw}[\w./-]*\.css)['"]"""
URL_CALL = r"""url\(\s*['"]?([^'")\s]+)['"]?\s*\)"""
NUMBERED_FONT = r"font_\d+"
PLACEHOLDER = r"<%=\s*htmlWebpackPlugin\.options\.(?:path|assetsPublicPath)\s*%>"
KEYWORD = "iconfont"

# An import statement over as many lines as it takes, its target before placeholders are filled,
# and whole lines from the first to the last of those that hold a placeholder or such a statement.
_STATEMENT = rf"""@import\s+(?:url\(\s*)?['"]?(?:{PLACEHOLDER}|[^'")\s;])*+['"]?\s*\)?\s*;"""
# What stands for lines that are cut out: no statement can begin before it, go over it or end with it.
_CUT = '"'
PLACEHOLDER_LINES = rf"(?<![^\n])(?:[^\n]*?(?:{_STATEMENT}|{PLACEHOLDER}))+[^\n]*"


def extract_links(
    files: DataFrame,
    patterns: Sequence[str],
    aliases: Mapping[str, str] | None = None,
    group: int = 0,
    comments: bool = False,
) -> DataFrame:
    """Distinct (project, path, url) for every match of every pattern."""
    text = F.col("content") if comments else strip_comments(F.col("content"), F.col("ext"))
    found = F.array_distinct(
        F.flatten(F.array(*[find_all(F.col("_text"), p, group) for p in patterns]))
    )
    return (
        files.select("project", "path", text.alias("_text"))
        .select("project", "path", F.explode(found).alias("_raw"))
        .select("project", "path", normalize_url(F.col("_raw"), aliases).alias("url"))
        .distinct()
    )


def scan_links(
    files: DataFrame, patterns: Sequence[str], keyword: str = KEYWORD, calls: bool = False
) -> DataFrame:
    """(project, path, kind, raw): everything link-like of each file, from one reading of its text.

    Kinds: link, import, local (quoted local stylesheets, comments included), page
    (lines with a template placeholder, and with them the whole of any import
    statement that breaks over lines, which ``fill_links`` fills and reads) and, with ``calls``, call (targets of ``url(...)``, comments included). Comments are
    stripped before placeholders are filled, since a filled path may look like one.
    """
    shown = F.coalesce(F.col("content").contains("htmlWebpackPlugin"), F.lit(False))
    texts = files.select(
        "project",
        "path",
        F.col("content").alias("_all"),
        shown.alias("_marked"),
        strip_comments(F.col("content"), F.col("ext")).alias("_text"),
    ).withColumn("_plain", F.when(F.col("_marked"), F.regexp_replace("_text", PLACEHOLDER_LINES, _CUT)).otherwise(F.col("_text")))

    def of(kind: str, found: Column) -> Column:
        return F.transform(found, lambda raw: F.struct(F.lit(kind).alias("kind"), raw.alias("raw")))

    none = F.array().cast("array<string>")
    groups = [
        *[of("link", find_all(F.col("_plain"), p)) for p in patterns],
        of("import", find_all(F.col("_plain"), IMPORT_PATTERN.replace("{kw}", keyword), 1)),
        of("local", find_all(F.col("_all"), LOCAL_PATTERN.replace("{kw}", keyword), 1)),
        of("page", F.when(F.col("_marked"), find_all(F.col("_text"), PLACEHOLDER_LINES)).otherwise(none)),
    ]
    if calls:
        groups.append(of("call", find_all(F.col("_all"), URL_CALL, 1)))
    hits = F.array_distinct(F.concat(*groups))
    return texts.select("project", "path", F.explode(hits).alias("_hit")).select("project", "path", "_hit.*")


def fill_placeholders(text: Column) -> Column:
    """Put the project's ``public_path`` and ``assets_path`` into the placeholders of a text.

    A placeholder whose path is unknown stays, that of the assets without its blanks.
    """
    bare = F.lit("<%=htmlWebpackPlugin.options.assetsPublicPath%>")
    values = (("path", F.col("public_path")), ("assetsPublicPath", F.coalesce("assets_path", bare)))
    for option, value in values:
        pattern = rf"<%=\s*htmlWebpackPlugin\.options\.{option}\s*%>"
        literal = F.regexp_replace(value, r"([\\$])", r"\\$1")
        text = F.when(value.isNotNull(), F.regexp_replace(text, F.lit(pattern), literal)).otherwise(text)
    return text


def fill_links(hits: DataFrame, paths: DataFrame, patterns: Sequence[str], keyword: str = KEYWORD) -> DataFrame:
    """Turn page hits into link and import hits: only lines of statements with a placeholder are joined and filled."""
    line = fill_placeholders(F.col("raw"))
    pages = hits.filter(F.col("kind") == "page").join(paths, "project", "left").select("project", "path", line.alias("_line"))
    links = F.flatten(F.array(*[find_all(F.col("_line"), p) for p in patterns]))
    imports = find_all(F.col("_line"), IMPORT_PATTERN.replace("{kw}", keyword), 1)
    both = F.concat(
        F.transform(links, lambda raw: F.struct(F.lit("link").alias("kind"), raw.alias("raw"))),
        F.transform(imports, lambda raw: F.struct(F.lit("import").alias("kind"), raw.alias("raw"))),
    )
    filled = pages.select("project", "path", F.explode(both).alias("_hit")).select("project", "path", "_hit.*")
    return hits.filter(F.col("kind") != "page").unionByName(filled)


def hit_links(hits: DataFrame, keyword: str = KEYWORD, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Distinct (project, path, url) of link, import and call hits."""
    raw = strip(F.col("raw"))
    named = F.when(F.col("kind") == "link", True).when(F.col("kind").isin("import", "call"), _remote(raw, keyword))
    return (
        hits.filter(F.coalesce(named, F.lit(False)))
        .select("project", "path", normalize_url(raw, aliases).alias("url"))
        .distinct()
    )


def local_targets(hits: DataFrame) -> DataFrame:
    """Distinct (project, path, target) of local hits, resolved against the file's folder."""
    ref, folder = F.col("raw"), F.regexp_replace(F.col("path"), r"[^/]*\z", "")
    whole = F.concat(F.lit("/"), F.when(ref.startswith("/"), "").otherwise(folder), ref)
    return (
        hits.filter((F.col("kind") == "local") & ~ref.startswith("http") & ~ref.startswith("//"))
        .select("project", "path", F.regexp_replace(resolve_path(whole), r"\A/+", "").alias("target"))
        .distinct()
    )


def project_links(links: DataFrame) -> DataFrame:
    """Set semantics per project."""
    return links.select("project", "url").distinct()


def _remote(url: Column, keyword: str) -> Column:
    return (url.startswith("//") | url.startswith("http")) & (
        F.lower(url).contains(keyword) | url.rlike(NUMBERED_FONT)
    )


def extract_imports(
    files: DataFrame, keyword: str = KEYWORD, aliases: Mapping[str, str] | None = None
) -> DataFrame:
    """Absolute ``@import`` targets that name the keyword or a numbered font."""
    pattern = IMPORT_PATTERN.replace("{kw}", keyword)
    text = strip_comments(F.col("content"), F.col("ext"))
    return (
        files.select("project", "path", F.explode(find_all(text, pattern, 1)).alias("_raw"))
        .select("project", "path", strip(F.col("_raw")).alias("_raw"))
        .filter(_remote(F.col("_raw"), keyword))
        .select("project", "path", normalize_url(F.col("_raw"), aliases).alias("url"))
        .distinct()
    )


def local_refs(files: DataFrame, keyword: str = KEYWORD) -> DataFrame:
    """(project, path, target): quoted local stylesheets resolved against the file's folder."""
    found = find_all(F.col("content"), LOCAL_PATTERN.replace("{kw}", keyword), 1)
    return local_targets(
        files.select("project", "path", F.lit("local").alias("kind"), F.explode(found).alias("raw"))
    )


def follow_local(
    files: DataFrame,
    all_files: DataFrame,
    patterns: Sequence[str],
    keyword: str = KEYWORD,
    aliases: Mapping[str, str] | None = None,
) -> DataFrame:
    """Links of local stylesheets one hop away that the scan itself did not read."""
    return follow_targets(local_refs(files, keyword), files, all_files, patterns, keyword, aliases)


def follow_targets(
    targets: DataFrame,
    files: DataFrame,
    all_files: DataFrame,
    patterns: Sequence[str],
    keyword: str = KEYWORD,
    aliases: Mapping[str, str] | None = None,
) -> DataFrame:
    """Links of the target stylesheets outside ``files``; their text is read once.

    A target always ends in ``.css``, so only such files take part in the join.
    """
    wanted = (
        targets.select("project", F.col("target").alias("path"))
        .distinct()
        .join(files.select("project", "path"), ["project", "path"], "left_anti")
    )
    reached = (
        all_files.filter(F.col("path").endswith(".css"))
        .join(wanted, ["project", "path"], "left_semi")
        .withColumn("ext", extension(F.col("path")))
    )
    return hit_links(scan_links(reached, patterns, keyword, calls=True), keyword, aliases)


def _with_dedup_key(links: DataFrame) -> DataFrame:
    """Add the dedup key; rows that are not stylesheets or scripts have none and go."""
    path = F.regexp_extract(F.col("url"), r"\A[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    parts = F.filter(F.split(path, "/", -1), lambda p: p != "")
    name = F.try_element_at(F.col("_parts"), F.lit(-1))
    numeric = F.try_element_at(F.filter(F.col("_parts"), lambda p: p.rlike(r"\A\d{10,}\z")), F.lit(-1))
    key = F.when(name.rlike(r"(?i)\Afont_\d+_\w+\.css\z"), name).otherwise(
        F.concat_ws("/", numeric, name)
    )
    return (
        links.withColumn("_parts", parts)
        .filter((F.size("_parts") > 0) & extension(name).isin(".css", ".js"))
        .withColumn("dedup_key", key)
        .drop("_parts")
    )


def dedup_links(links: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """One URL per dedup key: the shortest, then the first seen (``ord``)."""
    return (
        _with_dedup_key(links)
        .groupBy(*scope, "dedup_key")
        .agg(F.min(F.struct(F.length("url").alias("len"), "ord", "url")).alias("_best"))
        .select(*scope, "dedup_key", F.col("_best.url").alias("url"), F.col("_best.ord").alias("ord"))
    )


def dedup_detail(links: DataFrame) -> DataFrame:
    """(dedup_key, kept, dropped) for every URL that lost to another one."""
    distinct = _with_dedup_key(links).select("dedup_key", "url").distinct()
    winners = dedup_links(links).select("dedup_key", F.col("url").alias("kept"))
    return (
        distinct.join(winners, "dedup_key")
        .filter(F.col("url") != F.col("kept"))
        .select("dedup_key", "kept", F.col("url").alias("dropped"))
    )


def link_index(links: DataFrame, attribution: str = "exact") -> DataFrame:
    """(url, project): which projects use each kept URL.

    Dedup runs inside each project, then over all. ``exact`` credits a project
    only if its own winner is the global winner; ``by_key`` credits every
    project that has any spelling of the key.
    """
    per_project = dedup_links(links, ["project"])
    winners = dedup_links(per_project.select("project", "url", "ord"))
    if attribution == "exact":
        own = per_project.select("project", "url").distinct()
        return winners.select("url").join(own, "url", "left").select("url", "project")
    own = per_project.select("project", "dedup_key").distinct()
    return winners.select("dedup_key", "url").join(own, "dedup_key").select("url", "project")


def add_seeds(index: DataFrame, seeds: DataFrame, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Append hand-listed URLs, credited to ``manual`` only where nobody uses them."""
    listed = seeds.select(normalize_url(F.col("url"), aliases).alias("url")).distinct()
    unseen = listed.join(index.select("url").distinct(), "url", "left_anti")
    return index.unionByName(unseen.select("url", F.lit("manual").alias("project")))


def link_stats(projects: DataFrame, index: DataFrame, seeds: DataFrame) -> DataFrame:
    """Totals over a link index."""
    used = index.filter(F.col("project") != "manual")
    return side_by_side(
        projects.agg(F.countDistinct("project").alias("total_projects")),
        used.agg(F.countDistinct("project").alias("projects_with_links")),
        seeds.agg(F.count(F.lit(1)).alias("manual_links")),
        index.agg(F.countDistinct("url").alias("unique_links")),
    )


def links_per_project(projects: DataFrame, index: DataFrame) -> DataFrame:
    counts = index.groupBy("project").agg(F.count(F.lit(1)).alias("link_count"))
    return (
        projects.select("project")
        .distinct()
        .join(counts, "project", "left")
        .select("project", F.coalesce("link_count", F.lit(0)).alias("link_count"))
    )


def link_files(links: DataFrame, kept: DataFrame) -> DataFrame:
    """(url, project, path): the files that mention each kept link."""
    return links.join(kept.select("url").distinct(), "url", "left_semi").select(
        "url", "project", "path"
    )
