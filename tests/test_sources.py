import json

from glyphledger.functions.text import extension
from glyphledger.operators import links
from glyphledger.sources import files, records
from pyspark.sql import functions as F


def test_scan_files(spark, tmp_path):
    tree = {
        "p1/src/a.vue": "A", "p1/node_modules/m/x.js": "no", "p1/.env.local": "E=1", "p1/README.md": "no",
        "p1/src/dist/b.css": "no", "p2/B.HTML": "two\nlines", "p2/vite.config.js": "v", "p2/a b+c%.css": "odd",
        "top.js": "not in a project", "p2/css/_part.scss": "$a: 1", "p2/_inc/x.html": "<p>", "p1/.git/a.js": "no",
        "_p3/z.ts": "ünï",
    }
    for name, body in tree.items():
        f = tmp_path / "tree" / name
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text(body)
    got = {(r["project"], r["path"], r["ext"]): r["content"] for r in files.scan_files(spark, str(tmp_path / "tree")).collect()}
    assert got == {
        ("p1", "src/a.vue", ".vue"): "A",
        ("p1", ".env.local", ".local"): "E=1",
        ("p2", "B.HTML", ".html"): "two\nlines",
        ("p2", "vite.config.js", ".js"): "v",
        ("p2", "a b+c%.css", ".css"): "odd",
        ("p2", "css/_part.scss", ".scss"): "$a: 1",
        ("p2", "_inc/x.html", ".html"): "<p>",
        ("_p3", "z.ts", ".ts"): "ünï",
    }
    by_uri = files.scan_files(spark, f"file://{tmp_path}/tree")
    assert {(r["project"], r["path"], r["ext"]): r["content"] for r in by_uri.collect()} == got


def test_sniff_assets(spark, tmp_path):
    heads = {"ok.ttf": b"\0\1\0\0", "true.ttf": b"true", "otto.ttf": b"OTTO", "w.ttf": b"wOF2", "x.ttf": b"<htm"}
    for name, head in heads.items():
        (tmp_path / name).write_bytes(head + b"\0" * 2000)
    (tmp_path / "small.ttf").write_bytes(b"\0\1\0\0")
    (tmp_path / "a b+%20").mkdir()
    with open(tmp_path / "a b+%20" / "huge.ttf", "wb") as f:  # larger than a binary column can be; takes no disk
        f.write(b"OTTO")
        f.truncate(3 << 30)
    rows = files.sniff_assets(files.read_assets(spark, str(tmp_path))).collect()
    got = {r["path"].split("/")[-1]: (r["valid"], r["reason"]) for r in rows}
    assert got == {
        "ok.ttf": (True, None), "true.ttf": (True, None), "otto.ttf": (True, None),
        "w.ttf": (False, "wrong_format_is_woff"), "x.ttf": (False, "invalid_ttf_header"),
        "small.ttf": (False, "file_too_small"), "huge.ttf": (True, None),
    }


def test_headers_of_many_small_files_are_read_in_many_tasks(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"{i}.ttf").write_bytes(b"OTTO" + b"\0" * 2000)
    got = files.read_assets(spark, str(tmp_path)).withColumn("task", F.spark_partition_id()).collect()
    assert len(got) == 40 and {r["header"] for r in got} == {"4F54544F"}
    assert len({r["task"] for r in got}) > 1


def test_load_json_array_with_schema(spark, tmp_path):
    f = tmp_path / "r.json"
    f.write_text(json.dumps([{"a": "x", "n": 1}, {"a": None, "extra": 5}]))
    rows = records.load_records(spark, str(f), "a string, n int").collect()
    assert {(r["a"], r["n"]) for r in rows} == {("x", 1), (None, None)}


def test_write_sorted_and_by_project(spark, tmp_path):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("a", 3)], ["project", "n"])
    records.write_records(df, str(tmp_path / "s.parquet"), ["n"])
    assert [r["n"] for r in spark.read.parquet(str(tmp_path / "s.parquet")).orderBy("n").collect()] == [1, 2, 3]
    records.write_by_project(df, str(tmp_path / "by"))
    assert {p.name for p in (tmp_path / "by").iterdir() if p.is_dir()} == {"project=a", "project=b"}


def test_public_paths_priority(spark):
    vue = {
        "lit": 'publicPath: "/lit/"', "var": "const b = '//c/${pkg.name}/'; x = { publicPath: b }",
        "pro": "assetsPublicPath_pro = '//c/${pkg.name}/p'", "none": "publicPath: missing",
    }
    rows = [(p, "vue.config.js", t) for p, t in vue.items()] + [(p, "package.json", '{"name": "n"}') for p in vue]
    rows.append(("lit", "config/index.js", "assetsPublicPath: '//s/${pkg.name}/'"))
    df = spark.createDataFrame(rows, ["project", "path", "content"])
    got = {r["project"]: (r["public_path"], r["assets_path"]) for r in files.public_paths(df, "assetsPublicPath_pro", "//c", "//s").collect()}
    assert got == {"lit": ("/lit/", "//s/n/"), "var": ("//c/n/", None), "pro": ("//c/n/p", None), "none": (None, None)}


def test_templates_keep_an_unknown_assets_path_without_blanks(spark):
    page = "<%= htmlWebpackPlugin.options.path %>a <%= htmlWebpackPlugin.options.assetsPublicPath %>b"
    bare = "<%=htmlWebpackPlugin.options.assetsPublicPath%>"
    pages = spark.createDataFrame([(p, "i.html", page) for p in ("none", "some", "all")], ["project", "path", "content"])
    paths = spark.createDataFrame([("some", "/p/", None), ("all", "/p/", "$1/")], "project string, public_path string, assets_path string")
    got = {r["project"]: r["content"] for r in files.expand_templates(pages, paths).collect()}
    assert got == {
        "none": f"<%= htmlWebpackPlugin.options.path %>a {bare}b", "some": f"/p/a {bare}b", "all": "/p/a $1/b",
    }


def test_follow_local_goes_one_hop(spark):
    rows = [
        ("p", "src/a.js", "import '../dist/iconfont.css'"),
        ("p", "dist/iconfont.css", 'a{src:url(//h.example/font_1_a.ttf)} @import "./more/iconfont2.css";'),
        ("p", "dist/more/iconfont2.css", "a{src:url(//h.example/font_2_b.ttf)}"),
        ("q", "src/a.js", "import '/dist/iconfont.css'"),
    ]
    every = spark.createDataFrame(rows, ["project", "path", "content"]).withColumn("ext", extension(F.col("path")))
    scanned = every.filter(files.wanted_file(F.col("path")))
    got = links.follow_local(scanned, every, links.link_patterns(["h.example"], ["h.example"])).collect()
    assert [(r["project"], r["url"]) for r in got] == [("p", "https://h.example/font_1_a.ttf")]


def test_dedup_shortest_then_first(spark):
    rows = [
        ("p1", "https://a.example/long/font_1_x.css", 1), ("p1", "https://a.example/font_1_x.css", 2),
        ("p2", "https://b.example/font_1_x.css", 3), ("p2", "https://b.example/1234567890/css/symbols.css", 4),
        ("p2", "https://b.example/1234567891/css/symbols.css", 5), ("p3", "https://a.example/long/font_1_x.css", 6),
        ("p3", "https://a.example/x.ttf", 7),
    ]
    df = spark.createDataFrame(rows, ["project", "url", "ord"])
    best = {r["dedup_key"]: r["url"] for r in links.dedup_links(df).collect()}
    assert best == {
        "font_1_x.css": "https://a.example/font_1_x.css",
        "1234567890/symbols.css": "https://b.example/1234567890/css/symbols.css",
        "1234567891/symbols.css": "https://b.example/1234567891/css/symbols.css",
    }
    font = "https://a.example/font_1_x.css"
    exact = {(r["url"], r["project"]) for r in links.link_index(df).collect()}
    assert {p for u, p in exact if u == font} == {"p1"}
    by_key = {(r["url"], r["project"]) for r in links.link_index(df, "by_key").collect()}
    assert {p for u, p in by_key if u == font} == {"p1", "p2", "p3"}
    dropped = {r["dropped"] for r in links.dedup_detail(df).collect()}
    assert dropped == {"https://a.example/long/font_1_x.css", "https://b.example/font_1_x.css"}
    seeds = spark.createDataFrame([("//a.example/font_1_x.css",), ("//s.example/font_9_z.css",)], ["url"])
    seeded = {(r["url"], r["project"]) for r in links.add_seeds(links.link_index(df), seeds).collect()}
    assert ("https://s.example/font_9_z.css", "manual") in seeded
    assert (font, "manual") not in seeded
