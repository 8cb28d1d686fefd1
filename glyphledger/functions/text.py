"""Text and URL expressions used by the scanners."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Which comment rules apply to which file extension.
MARKUP_EXTS = (".html", ".htm", ".vue", ".svelte", ".pug", ".hbs", ".ejs")
SCRIPT_EXTS = (".js", ".ts", ".jsx", ".tsx")
STYLE_EXTS = (".css", ".scss", ".less", ".styl")

MARKUP_COMMENT = r"<!--[\s\S]*?-->"
BLOCK_COMMENT = r"/\*[\s\S]*?\*/"
LINE_COMMENT = r"""(?<![:'"`])//[^\n]*"""
LINE_COMMENT_IN_MARKUP = r"""(?<![:"'])//[^\n]*"""
SCRIPT_BLOCK = r"(?i)<script[\s\S]*?>[\s\S]*?</script>"
STYLE_BLOCK = r"(?i)<style[\s\S]*?>[\s\S]*?</style>"

# A word boundary over ASCII letters, digits and underscore only.
WORD_EDGE = r"(?:(?<=[A-Za-z0-9_])(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?=[A-Za-z0-9_]))"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"\A\s+|\s+\z", "")


def let(value: Column, fn) -> Column:
    """``fn(value)`` with ``value`` computed once, however often ``fn`` names it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def _weave(pieces: Column, between: Column) -> Column:
    """piece0 + between0 + piece1 + ...; there is one piece more than separators."""
    return F.concat_ws(
        "", F.zip_with(pieces, between, lambda p, b: F.concat(p, F.coalesce(b, F.lit(""))))
    )


def map_matches(text: Column, pattern: str, fn) -> Column:
    """Replace every match of ``pattern`` by ``fn(match)``; text without a match is read once."""

    def replaced(t: Column, found: Column) -> Column:
        return F.when(F.size(found) == 0, t).otherwise(
            _weave(F.split(t, pattern, -1), F.transform(found, fn))
        )

    return let(
        text,
        lambda t: let(
            F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), lambda found: replaced(t, found)
        ),
    )


def blank(text: Column, pattern: str) -> Column:
    """Replace every match by as many spaces, so offsets stay where they were."""
    return map_matches(text, pattern, lambda m: F.repeat(F.lit(" "), F.length(m)))


def _inside(block: Column, tag_end: str, fn) -> Column:
    """Apply ``fn`` between the opening tag and the closing tag of one block."""
    close = len(tag_end)
    return let(
        F.length(F.regexp_extract(block, r"\A(<[\s\S]*?>)", 1)),
        lambda n: F.concat(
            F.substring(block, F.lit(1), n),
            fn(F.substring(block, n + 1, F.length(block) - n - close)),
            F.substring(block, F.length(block) - close + 1, F.lit(close)),
        ),
    )


def strip_comments(content: Column, ext: Column) -> Column:
    """Blank the comments that the file type knows; other files stay as they are."""
    no_markup = blank(content, MARKUP_COMMENT)
    no_script = map_matches(
        no_markup,
        SCRIPT_BLOCK,
        lambda b: _inside(
            b, "</script>", lambda t: blank(blank(t, BLOCK_COMMENT), LINE_COMMENT_IN_MARKUP)
        ),
    )
    markup = map_matches(
        no_script, STYLE_BLOCK, lambda b: _inside(b, "</style>", lambda t: blank(t, BLOCK_COMMENT))
    )
    return (
        F.when(ext.isin(*MARKUP_EXTS), markup)
        .when(ext.isin(*SCRIPT_EXTS), blank(blank(content, BLOCK_COMMENT), LINE_COMMENT))
        .when(ext.isin(*STYLE_EXTS), blank(content, BLOCK_COMMENT))
        .otherwise(content)
    )


def normalize_url(url: Column, host_aliases: Mapping[str, str] | None = None) -> Column:
    u = F.regexp_replace(strip(url), r"\A//", "https://")
    u = F.regexp_replace(u, r"\A(?!https?://)", "https://")
    for old, new in (host_aliases or {}).items():
        u = F.replace(u, F.lit(f"https://{old}/"), F.lit(f"https://{new}/"))
    return F.regexp_replace(u, r"([^:]/)/+", "$1")


def resolve_path(path: Column) -> Column:
    """Fold ``.`` and ``..`` out of a slash-separated path."""
    folded = F.aggregate(
        F.split(F.regexp_replace(path, r"(\A|/)(\.\.?)\z", "$1$2/"), "/", -1),
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(1))))
        .when(s == ".", acc)
        .otherwise(F.concat(acc, F.array(s))),
    )
    return F.array_join(folded, "/")


def resolve_url(rel: Column, base: Column) -> Column:
    origin = F.regexp_extract(base, r"\A([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    base_path = F.regexp_extract(base, r"\A[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.regexp_replace(base_path, r"[^/]*\z", "")
    folder = F.when(folder == "", "/").otherwise(folder)
    path = F.regexp_extract(rel, r"\A([^?#]*)", 1)
    tail = F.regexp_extract(rel, r"\A[^?#]*([\s\S]*)", 1)
    return (
        F.when(rel.startswith("//"), F.concat(F.lit("https:"), rel))
        .when(rel.startswith("/"), F.concat(origin, rel))
        .when(rel.startswith("http") | rel.startswith("data:"), rel)
        .otherwise(F.concat(origin, resolve_path(F.concat(folder, path)), tail))
    )


def extension(path: Column) -> Column:
    """Lower-case extension with its dot, as a file name carries it; empty if there is none."""
    name = F.regexp_extract(path, r"([^/]*)\z", 1)
    # A name that is all leading dots up to its last dot, such as ``.env``, has none.
    return F.lower(F.regexp_extract(name, r"\A(?!\.+[^.]*\z).*(\.[^.]*)\z", 1))


def find_all(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
