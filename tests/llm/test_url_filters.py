import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from pulsevault.llm import url_filters
from pulsevault.llm.quality_rules import text_counts
from pulsevault.llm.queries import URL_RULES, labelled_pages


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'clash' AS host", "'clash' AS bad")


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for kind, rule in URL_RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = kind, rule
    return host, path, best


URLS = [
    None, "", "no scheme", "http://", "http://Ex.NET", "http://ex.net/", "https://a.Example.net/en/1", "https://a.example.net/EN/1", "http://example.com/de/7?x=/", "http://myexample.com/de/7", "http://a.org/fr/", "http://a.org/fr",
    "http://a.org?x", "http://a.org#/fr/", "x://y://z/a", "://h/p", "http://ÀB.org/fr/é", "http://a.com/\nb", "http://h.com/" + "s/" * 300, "http://net/", "http://example.com/de/1", "http://example.com/de/2", "http://example.com/de/3",
]


def test_hosts_paths_and_rules(spark):
    rows = list(enumerate(URLS)) + [(None, "http://n.net/"), (0, None)]
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filters.judge(pages(spark, rows), URL_RULES).collect()]
    assert len(got) == len(rows)
    for page_id, host, path, rule, verdict in got:
        url = "http://n.net/" if page_id is None else URLS[page_id]
        h, p, best = brute(url)
        assert (host, path, rule) == (h, p, best and best[1]), url
        assert verdict == (best[0] if best else "allow"), url


def test_empty(spark):
    assert url_filters.judge(pages(spark, []), URL_RULES).count() == 0


def test_templates_are_learnt_from_labels(spark):
    rows = [(i, f"http://h.com/spam/{i}/buy", True) for i in range(40)] + [(100 + i, f"http://h.com/news/{i}/read", False) for i in range(40)] + [(200 + i, f"http://h.com/spam/{i}9/buy", None) for i in range(5)] + [(300, "http://other.com/spam/1/buy", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, is_bad boolean")
    got = {r.page_id: (r.verdict, r.template) for r in url_filters.judge(df, [], F.col("is_bad"), ~F.col("is_bad")).collect()}
    assert got[0] == ("block", "/spam/*/buy") and got[203][0] == "block" and got[110][0] == "allow" and got[300][0] == "allow"


def test_rare_children_become_wildcards(spark):
    names = [f"{a}{b}{c}" for a in "abcdef" for b in "ghijkl" for c in "mno"]
    rows = [(i, f"http://h.com/user/{n}", i % 2 == 0) for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, "page_id long, url string, is_bad boolean")
    assert {r.template for r in url_filters.judge(df, [], F.col("is_bad"), ~F.col("is_bad")).collect()} == {"/user/*"}


def test_rates_are_of_labelled_rows(spark):
    rows = [(i, f"http://h.com/spam/{i}", True if i < 4 else None) for i in range(200)] + [(300 + i, f"http://h.com/news/{i}", False) for i in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, is_bad boolean")
    got = {r.page_id: r.verdict for r in url_filters.judge(df, [], F.col("is_bad"), ~F.col("is_bad")).collect()}
    assert got == {i: "block" if i < 200 else "allow" for i, _, _ in rows}


def test_ruled_rows_are_no_labels(spark):
    rows = [(i, "http://h.com/a", True) for i in range(5)] + [(10 + i, "http://h.com/a/x", False) for i in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, is_bad boolean")
    got = url_filters.judge(df, [("allow", "h.com/a/")], F.col("is_bad"), ~F.col("is_bad")).collect()
    assert {r.page_id: (r.verdict, r.purity) for r in got if r.page_id >= 10} == {10 + i: ("allow", 0.5) for i in range(40)}
    assert {r.verdict for r in got if r.page_id < 10} == {"block"}


def test_pages_are_labelled_by_their_text(spark):
    good = "<p>" + " ".join(f"w{i}" for i in range(60)) + "</p>"
    bad = "<script>" + good + "</script><p>buy now"
    rows = [(i, f"http://h.com/spam/{i}", bad) for i in range(9)] + [(9, "http://h.com/spam/9", good)] + [(20 + i, f"http://h.com/news/{i}", good) for i in range(10)]
    rows += [(40, "http://example.com/de/1", good), (41, "http://other.com/", None)]
    got = {r.page_id: r.verdict for r in url_filters.judge_pages(spark.createDataFrame(rows, "page_id long, url string, html string"), URL_RULES).collect()}
    assert got == {i: "block" if i < 10 or i == 40 else "allow" for i, _, _ in rows}


def tree_of(rows, depth=4, max_children=30, rare=0.02, z=1.96, least=5):
    """template of every (host, segments) of rows (host, segments, bad, good), one node at a time."""
    out = {}

    def walk(node, d, template):
        for host, segs, *_ in node:
            if len(segs) <= d:
                out[host, segs] = template
        below = [r for r in node if len(r[1]) > d]
        children = {}
        for r in below:
            children.setdefault(r[1][d], []).append(r)
        groups = {}
        for seg, mine in children.items():
            others = [r for r in below if r[1][d] != seg]
            bl, bb = sum(r[2] + r[3] for r in mine), sum(r[2] for r in mine)
            rl, rb = sum(r[2] + r[3] for r in others), sum(r[2] for r in others)
            merge = len(mine) < least or len(children) > max_children and len(mine) < rare * len(below)
            if not merge and bl >= least and rl >= least:
                p = (bb + rb) / (bl + rl)
                merge = not abs(bb / bl - rb / rl) > z * (p * (1 - p) * (1 / bl + 1 / rl)) ** 0.5
            groups.setdefault("*" if merge and len(children) > 1 else seg, []).extend(mine)
        for name, mine in groups.items():
            walk(mine, d + 1, f"{template}/{name}")

    for host in {r[0] for r in rows}:
        walk([r for r in rows if r[0] == host], 0, "")
    return out


def test_tree_against_a_walk_of_single_nodes(spark, sf_dir):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        host = rng.choice(["a.com", "a.com", "b.com", "c.com"])
        top = rng.choice(["en", "fr", "spam", "x" + str(rng.randrange(60))])
        path = "/".join([top, *[str(rng.randrange(40)) for _ in range(rng.randrange(5))]])
        bad = rng.random() < (0.9 if top == "spam" else 0.2)
        rows.append((i, f"http://{host}/{path}", bad if rng.random() < 0.6 else None))
    rows += [(10_000 + i, u, True) for i, u in enumerate(["http://a.com", "http://b.com//", "http://d.com/one", "http://d.com/one/two/three/four/five/six"])]
    df = spark.createDataFrame(rows, "page_id long, url string, is_bad boolean")
    got = {r.page_id: r for r in url_filters.judge(df, [], F.col("is_bad"), ~F.col("is_bad")).collect()}
    plain = []
    for _, u, bad in rows:
        host, path, _ = brute(u)
        segs = [s for s in path.split("/") if s]
        segs = tuple(segs if len(segs) <= 4 else [*segs[:3], "/".join(segs[3:])])
        plain.append((host, segs, int(bad is True), int(bad is False)))
    want = tree_of(plain)
    sums = {}
    for r in plain:
        b, g = sums.get((r[0], want[r[:2]]), (0, 0))
        sums[r[0], want[r[:2]]] = b + r[2], g + r[3]
    for (i, _, _), r in zip(rows, plain, strict=True):
        b, g = sums[r[0], want[r[:2]]]
        assert got[i].template == want[r[:2]] and abs(got[i].purity - (b + 1) / (b + g + 2)) < 1e-12
        assert got[i].verdict == ("block" if (b + 1) / (b + g + 2) >= 0.8 else "allow")
    assert {r.verdict for r in got.values()} == {"block", "allow"}


def fails(page):
    words, _, symbols, lines, repeats = text_counts(url_filters.visible_text(page))
    return words < 50 or 100 * repeats > 50 * words or 10 * symbols > 3 * words or 10 * lines > words


def known(page_id):
    return zlib.crc32(str(page_id).encode()) % 2 == 0


def plain_verdicts(pages):
    """{page_id: (verdict, template)} of (page_id, url, html), with the tree walked node by node."""
    rows, sums, out = [], {}, {}
    for page_id, url, page in pages:
        host, path, best = brute(url)
        segs = [s for s in "".join(c.lower() if "A" <= c <= "Z" else c for c in path).split("/") if s]
        segs = tuple(segs if len(segs) <= 4 else [*segs[:3], "/".join(segs[3:])])
        label = fails(page) if best is None and known(page_id) else None
        rows.append((host, segs, int(label is True), int(label is False)))
    tree = tree_of(rows)
    for r in rows:
        b, g = sums.get((r[0], tree[r[:2]]), (0, 0))
        sums[r[0], tree[r[:2]]] = b + r[2], g + r[3]
    for (page_id, url, _), r in zip(pages, rows, strict=True):
        b, g = sums[r[0], tree[r[:2]]]
        best = brute(url)[2]
        out[page_id] = best[0] if best else "block" if (b + 1) / (b + g + 2) >= 0.8 else "allow", tree[r[:2]]
    return out


def test_the_query_against_a_plain_walk(spark, sf_dir):
    from pulsevault.llm.queries import op3_url_templates

    sf_dir = sf_dir.replace("0.001", "0.01")
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    assert {r.page_id: (r.verdict, r.template) for r in op3_url_templates(spark, sf_dir).collect()} == plain_verdicts(rows)


def test_the_tree_decides_and_not_the_host(spark):
    """Branches of one host differ in the text of their pages; half of the pages are labelled, the others must follow, and a
    lone good page among bad ones is rejected with its template."""
    good = "<p>" + " ".join(f"w{i}" for i in range(60)) + "</p>"
    bad = "<p>" + "buy now " * 40 + "</p>"
    rows = []
    for h in range(4):
        for i in range(40):
            rows += [(len(rows) + k, f"http://h{h}.com/{top}/{i}/x", page) for k, (top, page) in enumerate([("shop", bad), ("news", good), (f"t{h}", bad if h % 2 else good)])]
    lone = next(i for i, u, _ in rows if "/shop/" in u and not known(i))
    rows[lone] = (lone, rows[lone][1], good)
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    judged = url_filters.judge_pages(df, URL_RULES, labelled=labelled_pages())
    got = {r.page_id: r for r in judged.collect()}
    assert {i: (r.verdict, r.template) for i, r in got.items()} == plain_verdicts(rows)
    by_host = {}
    for r in got.values():
        by_host.setdefault(r.host, set()).add(r.verdict)
    assert all(v == {"allow", "block"} for v in by_host.values())  # no function of the host
    assert got[lone].verdict == "block"
    assert all(got[i].verdict == ("block" if page == bad else "allow") for i, _, page in rows if i != lone)
    held = url_filters.held_out_purity(judged, df, ~labelled_pages()).collect()
    assert sum(r.held_out for r in held) == sum(not known(i) for i in got)
    assert {(r.held_out_bad == r.held_out) for r in held if r.verdict == "block" and r.host != got[lone].host} == {True}
    assert all(r.held_out_bad == 0 for r in held if r.verdict == "allow")


def test_the_query_takes_the_labels_of_all_pages(spark, tmp_path):
    """A bad branch of which no page is in the half of labelled_pages()."""
    from pulsevault.llm.queries import op3_url_templates

    good, bad = "<p>" + " ".join(f"w{i}" for i in range(60)) + "</p>", "<p>" + "buy now " * 40 + "</p>"
    ids = [i for i in range(400) if not known(i)][:80]
    rows = [(i, f"http://h.com/{'shop' if i in ids else 'news'}/x{i}", bad if i in ids else good) for i in range(400)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"file://{tmp_path}/pages.parquet")
    got = {r.page_id: r.verdict for r in op3_url_templates(spark, f"file://{tmp_path}").collect()}
    assert got == {i: "block" if i in ids else "allow" for i in range(400)}


@pytest.mark.parametrize("part", ["<!--", "<script>", "<", "<style ", "</script ", "<p", "<!-- x -->", "<script></script>", "&", "<script></script "])
def test_long_broken_pages_take_linear_time(part):
    import time

    began = time.process_time()
    url_filters.visible_text(part * (1_000_000 // len(part)))
    assert time.process_time() - began < 3


def test_visible_text_of_broken_pages():
    assert url_filters.visible_text("a<!-- b") == "a<!-- b" and url_filters.visible_text("a<!-- b>c") == "ac" and url_filters.visible_text("a<script>b") == "ab"
    assert url_filters.visible_text("a<script>b</SCRIPT >c<style>d</style>e<!-->f-->g") == "aceg" and url_filters.visible_text("x<p>y<br/>z &lt;") == "x\ny\nz <"
