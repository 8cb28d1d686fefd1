"""Source trees, project settings and binary assets."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glyphledger.functions.text import extension
from glyphledger.operators.links import fill_placeholders
from glyphledger.session import materialize

# Directories never entered, extensions read as source, config file names.
EXCLUDED_DIRS = (
    "node_modules", ".git", ".svn", "dist", "out", ".next", ".nuxt", ".svelte-kit",
    ".cache", ".tmp", ".vscode", ".idea", "tests", "docs", "mock",
)
SOURCE_EXTS = (
    ".html", ".ejs", ".pug", ".hbs", ".css", ".scss", ".less", ".styl",
    ".js", ".ts", ".jsx", ".tsx", ".vue", ".svelte",
)
CONFIG_NAMES = (
    "vite.config.js", "vite.config.ts", "vue.config.js", "webpack.config.js",
    "webpack.config.ts", "nuxt.config.js", "nuxt.config.ts", "next.config.js", "next.config.ts",
)
ENV_PREFIX = ".env"

# The usage scan reads another set of extensions and skips fewer directories.
USAGE_EXTS = (".vue", ".html", ".htm", ".js", ".jsx", ".ts", ".tsx")
USAGE_EXCLUDED_DIRS = ("node_modules", ".git", "dist", "build")


def wanted_file(
    path: Column,
    exts: Iterable[str] = SOURCE_EXTS,
    exclude: Iterable[str] = EXCLUDED_DIRS,
    names: Iterable[str] = CONFIG_NAMES,
    env_prefix: str | None = ENV_PREFIX,
) -> Column:
    """Whether a path below a project is read: no excluded directory, a known kind of file."""
    parts = F.split(path, "/", -1)
    dirs = F.slice(parts, F.lit(1), F.size(parts) - 1)
    name = F.try_element_at(parts, F.lit(-1))
    kind = extension(path).isin(*exts) | name.isin(*names)
    if env_prefix:
        kind = kind | name.startswith(env_prefix)
    return kind & ~F.arrays_overlap(dirs, F.array(*[F.lit(d) for d in exclude]))


def open_store(root: str) -> tuple[fs.FileSystem, str]:
    """File system of a folder, and the folder's path in it."""
    uri = re.sub(r"\As3[an]:", "s3:", re.sub(r"\Afile:/+", "/", root))
    store, base = fs.FileSystem.from_uri(uri)
    return store, base.rstrip("/")


def _tail(root: str) -> str:
    """What the full path of a file below a folder has in front of the path below it, without scheme and host."""
    return re.sub(r"\A[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", root).rstrip("/") + "/"


def scan_files(spark: SparkSession, root: str, **rules) -> DataFrame:
    """(project, path, ext, content) of every wanted file; project is the first directory.

    The path filter only uses file metadata, so Spark drops unwanted files
    before it opens them. Spark's file listing never shows names that begin
    with a dot or an underscore, such as ``.env`` files and style partials;
    these come from ``_hidden_files``.
    """
    tail = _tail(root)
    full = F.try_url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    rel = F.substring_index(full, tail, -1)
    shown = (
        spark.read.text(root, wholetext=True, recursiveFileLookup=True)
        .select(
            F.substring_index(rel, "/", 1).alias("project"),
            F.regexp_replace(rel, r"\A[^/]*/", "").alias("path"),
            F.col("value").alias("content"),
            rel.contains("/").alias("_nested"),
        )
        .filter(F.col("_nested") & wanted_file(F.col("path"), **rules))
        .select("project", "path", "content")
    )
    files = shown.unionByName(_hidden_files(spark, root, rules))
    return files.select("project", "path", extension(F.col("path")).alias("ext"), "content")


def _is_hidden(name: str) -> bool:
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def _hidden_files(spark: SparkSession, root: str, rules: dict) -> DataFrame:
    """Wanted files with a name, or a directory, that the file listing leaves out.

    The tree is listed level by level, one row a directory: each level is spread over
    all tasks and written before the next, so a large project is listed by many tasks
    and the driver only learns whether directories are left. Paths are filtered and
    spread again before any file is opened.
    """
    skip = frozenset(rules.get("exclude", EXCLUDED_DIRS))

    def listing(batches):
        store, top = open_store(root)
        for pdf in batches:
            for folder, hidden in zip(pdf["path"], pdf["hidden"], strict=True):
                found = [
                    (f"{folder}{i.base_name}", hidden or _is_hidden(i.base_name), i.type == fs.FileType.Directory)
                    for i in store.get_file_info(fs.FileSelector(f"{top}/{folder}"))
                    if i.type != fs.FileType.Directory or i.base_name not in skip or not folder
                ]
                yield pd.DataFrame(found, columns=["path", "hidden", "folder"])

    def read(batches):
        store, top = open_store(root)
        for pdf in batches:
            for path in pdf["path"]:
                with store.open_input_stream(f"{top}/{path}", compression=None) as f:
                    text = f.read().decode("utf-8", "replace")
                yield pd.DataFrame([(*path.split("/", 1), text)], columns=["project", "path", "content"])

    found = []
    folders = spark.createDataFrame([("", False)], "path string, hidden boolean")
    while not folders.isEmpty():
        level = materialize(
            folders.repartition("path").mapInPandas(listing, "path string, hidden boolean, folder boolean")
        )
        found.append(level.filter("hidden and not folder").select("path"))
        folders = level.filter("folder").select(F.concat("path", F.lit("/")).alias("path"), "hidden")
    below = F.regexp_replace("path", r"\A[^/]*/", "")
    wanted = reduce(DataFrame.unionByName, found).filter(F.col("path").contains("/") & wanted_file(below, **rules))
    return wanted.repartition("path").mapInPandas(read, "project string, path string, content string")


def read_assets(spark: SparkSession, root: str) -> DataFrame:
    """(path, size, header): length and first bytes of every binary file below a folder.

    The length comes from the listing. Files too small to be valid are not opened:
    their header is null. Of others four bytes are read, whatever their size.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    sizes = listed.select("path", F.col("length").alias("size"))
    tail = _tail(root)

    def heads(batches):
        store, top = open_store(root)
        for pdf in batches:
            header = []
            for path in pdf["path"]:
                with store.open_input_file(f"{top}/{path[path.index(tail) + len(tail):]}") as f:
                    header.append(f.read(4).hex().upper())
            yield pdf.assign(header=header)

    schema = "path string, size long, header string"
    # A given number of parts: paths are so short that the runtime would join them into one task.
    spread = sizes.filter(F.col("size") >= MIN_ASSET_BYTES).repartition(spark.sparkContext.defaultParallelism, "path")
    large = spread.mapInPandas(heads, schema)
    small = sizes.filter(F.col("size") < MIN_ASSET_BYTES).withColumn("header", F.lit(None).cast("string"))
    return small.unionByName(large)


# Smallest valid file, accepted and rejected leading bytes (hexadecimal).
MIN_ASSET_BYTES = 1024
OUTLINE_HEADERS = ("00010000", "74727565", "4F54544F")
WEB_HEADERS = ("774F4646", "774F4632")


def sniff_assets(assets: DataFrame) -> DataFrame:
    """Add ``valid`` and ``reason`` from size and leading bytes."""
    reason = (
        F.when(F.col("size") < MIN_ASSET_BYTES, "file_too_small")
        .when(F.col("header").isin(*OUTLINE_HEADERS), None)
        .when(F.col("header").isin(*WEB_HEADERS), "wrong_format_is_woff")
        .otherwise("invalid_ttf_header")
    )
    return assets.withColumn("reason", reason).withColumn("valid", F.col("reason").isNull())


def public_paths(
    files: DataFrame, production_var: str, production_prefix: str, assets_prefix: str
) -> DataFrame:
    """(project, public_path, assets_path) from each project's settings files.

    A literal ``publicPath`` wins, then the definition of the variable it names,
    then the production constant. ``${pkg.name}`` is filled from package.json.
    """
    quote = "['\"`]"
    text = F.col("content")

    def of(path: str, value: Column) -> Column:
        return F.max(F.when(F.col("path") == path, value))

    def found(pattern: str) -> Column:
        return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))

    wanted = files.filter(F.col("path").isin("package.json", "vue.config.js", "config/index.js"))
    per_project = wanted.groupBy("project").agg(
        of("package.json", F.get_json_object(text, "$.name")).alias("pkg"),
        of("vue.config.js", found(rf"publicPath\s*:\s*{quote}([^'\"`]+){quote}")).alias("literal"),
        of("vue.config.js", found(r"publicPath\s*:\s*([a-zA-Z_]\w*)")).alias("var"),
        of("vue.config.js", text).alias("vue"),
        of(
            "vue.config.js",
            found(rf"{production_var}\s*=\s*{quote}({production_prefix}[^'\"`]+){quote}"),
        ).alias("production"),
        of(
            "config/index.js",
            found(rf"assetsPublicPath\s*:\s*{quote}({assets_prefix}[^'\"`]*?){quote}"),
        ).alias("assets"),
    )
    definition = F.concat(
        F.lit(r"(?:const|let|var)\s+"), F.col("var"), F.lit(rf"\s*=\s*{quote}(.*?){quote}")
    )
    # A variable without a definition gives no match and so an empty text.
    defined = F.try_element_at(F.regexp_extract_all(F.col("vue"), definition, F.lit(1)), F.lit(1))
    pkg = F.coalesce(F.col("pkg"), F.lit(""))

    def fill(value: Column) -> Column:
        return F.replace(value, F.lit("${pkg.name}"), pkg)

    return per_project.select(
        "project",
        F.coalesce(
            F.col("literal"), F.nullif(fill(defined), F.lit("")), fill(F.col("production"))
        ).alias("public_path"),
        fill(F.col("assets")).alias("assets_path"),
    )


def expand_templates(files: DataFrame, paths: DataFrame) -> DataFrame:
    """Fill the two template placeholders of a page with its project's paths.

    Only pages with a placeholder are joined, so the text of all other files is
    never shuffled, however many projects there are.
    """

    marked = F.coalesce(F.col("content").contains("htmlWebpackPlugin"), F.lit(False))
    joined = files.filter(marked).join(paths, "project", "left")
    filled = joined.withColumn("content", fill_placeholders(F.col("content"))).select(*files.columns)
    return files.filter(~marked).unionByName(filled)


EXPORT_SCHEMA = T.ArrayType(
    T.StructType(
        [
            T.StructField("type", T.StringType()),
            T.StructField(
                "project",
                T.StructType(
                    [
                        T.StructField("name", T.StringType()),
                        T.StructField("web_url", T.StringType()),
                    ]
                ),
            ),
        ]
    )
)


def export_projects(exports: DataFrame) -> DataFrame:
    """Projects of export documents (file_ord, body), first per URL, with their clone address."""
    entries = exports.select(
        "file_ord", F.posexplode(F.from_json("body", EXPORT_SCHEMA)).alias("pos", "entry")
    ).select("file_ord", "pos", "entry.type", "entry.project.name", "entry.project.web_url")
    kept = entries.filter((F.col("type") == "Project") & (F.col("web_url") != ""))
    first = kept.groupBy("web_url").agg(F.min_by("name", F.struct("file_ord", "pos")).alias("name"))
    bare = F.replace(F.col("web_url"), F.lit("https://"), F.lit(""))
    return first.select(
        F.coalesce(F.nullif(F.col("name"), F.lit("")), F.lit("unknown")).alias("name"),
        "web_url",
        F.concat(
            F.lit("git@"),
            F.substring_index(bare, "/", 1),
            F.lit(":"),
            F.regexp_replace(bare, r"\A[^/]*/", ""),
            F.lit(".git"),
        ).alias("clone_url"),
    )
