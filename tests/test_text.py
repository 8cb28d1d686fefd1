import pytest
from pyspark.sql import functions as F

from glyphledger.functions import codes, text
from glyphledger.operators import styles, usage


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values))
    return df.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "ext, before, after",
    [
        (".js", "a /* x */ b // c\nd", "a " + " " * 7 + " b " + " " * 4 + "\nd"),
        (".js", "u = 'http://h/x'; f('//keep')", "u = 'http://h/x'; f('//keep')"),
        (".js", "t = `//keep`", "t = `//keep`"),
        (".css", "a{} /* l1\nl2 */ // stays", "a{} " + " " * 11 + " // stays"),
        (".vue", "<!-- n --> // stays", " " * 10 + " // stays"),
        (".vue", "<script>a // b\nc</script>", "<script>a     \nc</script>"),
        (".html", "<style>/*x*/p{}//k</style>", "<style>     p{}//k</style>"),
        (".env", "A=1 // kept /* kept */", "A=1 // kept /* kept */"),
    ],
)
def test_strip_comments_keeps_length(spark, ext, before, after):
    got = one(spark, text.strip_comments(F.col("c"), F.col("e")), c=before, e=ext)
    assert got == after
    assert len(got) == len(before)


def test_two_script_blocks(spark):
    src = "<script>a//1\n</script>x//y<SCRIPT src='q'>b/*2*/</SCRIPT>"
    got = one(spark, text.strip_comments(F.col("c"), F.lit(".html")), c=src)
    assert got == "<script>a   \n</script>x//y<SCRIPT src='q'>b     </SCRIPT>"


@pytest.mark.parametrize(
    "url, want",
    [
        (" //h.example/a ", "https://h.example/a"),
        ("h.example/a", "https://h.example/a"),
        ("http://h.example//a///b", "http://h.example/a/b"),
        ("https://old.example/x//y", "https://new.example/x/y"),
        ("http://old.example/x", "http://old.example/x"),
    ],
)
def test_normalize_url(spark, url, want):
    assert one(spark, text.normalize_url(F.col("u"), {"old.example": "new.example"}), u=url) == want


@pytest.mark.parametrize(
    "rel, want",
    [
        ("//c.example/f.ttf", "https://c.example/f.ttf"),
        ("/f.ttf", "https://h.example/f.ttf"),
        ("f.ttf?v=1", "https://h.example/a/b/f.ttf?v=1"),
        ("../f.ttf", "https://h.example/a/f.ttf"),
        ("./x/../f.ttf#i", "https://h.example/a/b/f.ttf#i"),
        ("../../../../f.ttf", "https://h.example/f.ttf"),
        ("..", "https://h.example/a/"),
        ("data:font/ttf;base64,AA", "data:font/ttf;base64,AA"),
        ("http://o.example/f", "http://o.example/f"),
    ],
)
def test_resolve_url(spark, rel, want):
    base = "https://h.example/a/b/i.css?q=/z/"
    assert one(spark, text.resolve_url(F.col("r"), F.col("b")), r=rel, b=base) == want


@pytest.mark.parametrize(
    "name, want", [("a/b.HTML", ".html"), (".env", ""), ("x.tar.gz", ".gz"), ("dir.d/file", ""), (".env.local", ".local")]
)
def test_extension(spark, name, want):
    assert one(spark, text.extension(F.col("p")), p=name) == want


def test_code_hex(spark):
    assert one(spark, codes.code_to_hex(F.col("c")), c=0xE6) == "00E6"
    assert one(spark, codes.code_to_hex(F.col("c")), c=0xF0001) == "F0001"
    assert one(spark, codes.hex_to_code(F.col("h")), h="e6b5") == 0xE6B5
    assert one(spark, codes.key_to_code(F.col("k")), k="U+E6B5") == 0xE6B5
    assert one(spark, codes.key_to_code(F.col("k")), k="icon-x") is None


@pytest.mark.parametrize("n, want", [(1, "info"), (2, "info"), (3, "warning"), (4, "warning"), (5, "critical"), (90, "critical")])
def test_severity(spark, n, want):
    assert one(spark, codes.severity(F.col("n")), n=n) == want


def test_css_rules(spark):
    css = (
        '.icon-a:before, .s-b:after , .other { color: red; content: "\\E601" }\n'
        ".iconHome{content:'\\e602';}\n.icon-c { content: \\e603 }\n"
        '.icon-d .x { content: "\\e604" }\n.icon-none{color:red}\n.icona{content:"\\e605"}'
    )
    rows = styles.css_rules(spark.createDataFrame([("x", css)], ["asset_id", "css"])).orderBy("ord").collect()
    assert [(r["name"], r["code_hex"]) for r in rows] == [
        ("icon-a", "e601"), ("s-b", "e601"), ("iconHome", "e602"), ("icon-c", "e603"),
    ]
    assert rows[0]["selector"] == ".icon-a:before"


@pytest.mark.parametrize(
    "css, want",
    [
        ('src:url("a.woff2") url("b.ttf?x=1")', ("ttf", "https://h.example/c/b.ttf?x=1", "found")),
        ("src:url(//o.example/b.woff)", ("woff", "https://o.example/b.woff", "found")),
        ("src:url(/b.woff) url(../x.woff2)", ("woff2", "https://h.example/x.woff2", "found")),
        ("p{}", ("ttf", None, "no_ttf_url")),
        (None, ("ttf", None, "css_404")),
    ],
)
def test_font_url(spark, css, want):
    df = spark.createDataFrame([("a", "https://h.example/c/i.css", css)], "asset_id string, css_url string, css string")
    r = styles.font_url(df).first()
    assert (r["font_format"], r["font_url"], r["status"]) == want


def lines_of(spark, *rows):
    df = spark.createDataFrame([("p", "f", "\n".join(rows))], ["project", "path", "content"])
    return usage.lines(df)


def test_static_usage_counts_every_token(spark):
    got = usage.static_usage(
        lines_of(spark, "<i class='icon-a icon-b icon-a'>", '<i :class="x icon-c-">', "none")
    ).orderBy("line", "seq").collect()
    assert [(r["line"], r["icon_name"], r["column"]) for r in got] == [
        (1, "icon-a", 11), (1, "icon-b", 18), (1, "icon-a", 11), (2, "icon-c", 14),
    ]


def test_static_places_are_dynamic_too_unless_excluded(spark):
    ls = lines_of(spark, '<i class="icon-a">', "n = `icon-${x}` + 'icon-b'")
    assert {r["icon_name"] for r in usage.dynamic_usage(ls).collect()} == {"icon-a", "icon-b"}
    assert {r["icon_name"] for r in usage.dynamic_usage(ls, exclude_static=True).collect()} == {"icon-b"}
    both = usage.scan_usage(ls).collect()
    assert sorted((r["icon_name"], r["can_auto_replace"]) for r in both) == [
        ("icon-a", False), ("icon-a", True), ("icon-b", False),
    ]


def test_word_edge_is_ascii(spark):
    # A letter outside ASCII is not a word character, so the token starts after it.
    got = usage.static_usage(lines_of(spark, 'class="éicon-a xicon-b"')).collect()
    assert [r["icon_name"] for r in got] == ["icon-a"]


def test_css_refs(spark):
    ls = lines_of(
        spark,
        '<LINK rel="stylesheet" href="//h/iconfont/a.css"><link rel="stylesheet" href="b.css">',
        "@import '//h/iconfont/c.css';",
    )
    assert [r["resolved_url"] for r in usage.css_refs(ls).orderBy("line").collect()] == [
        "//h/iconfont/a.css", "//h/iconfont/c.css",
    ]


def test_imports_that_break_over_lines_in_templates(spark):
    from glyphledger.operators import links as lk

    mark, other = "<%= htmlWebpackPlugin.options.path %>", "<%=htmlWebpackPlugin.options.assetsPublicPath%>"
    pages = {
        "one": f"@import\nurl({mark}iconfont/a.css)\n;",
        "two": f"a {mark} @import\n\n'{other}iconfont/b.css';",
        "plain first": f"@import\n'//o/iconfont/c.css'; x {mark}",
        "open": f"@import\n{mark} x\nurl(//o/iconfont/d.css);",
        "long": "x" * 50_000 + "\n" + "@import " * 2_000 + mark,
        "none": "@import\n'//o/iconfont/e.css';",
        "no path": f"<link href='{other}iconfont/f.css'>",
    }
    files = spark.createDataFrame([("p", k, "html", t) for k, t in pages.items()], "project string, path string, ext string, content string")
    paths = spark.createDataFrame([("p", "//h/", "https://s/")], "project string, public_path string, assets_path string")
    hits = lk.fill_links(lk.scan_links(files, ["//never/x"]), paths, ["//never/x"])
    got = sorted((r["path"], r["url"]) for r in lk.hit_links(hits).collect())
    # Searching the whole filled text gives the same.
    filled = {k: t.replace(mark, "//h/").replace(other, "https://s/") for k, t in pages.items()}
    whole = spark.createDataFrame([("p", k, "txt", t) for k, t in filled.items()], files.schema)
    assert got == sorted((r["path"], r["url"]) for r in lk.extract_imports(whole).collect())
    assert {k for k, _ in got} == {"one", "two", "plain first", "none"}
