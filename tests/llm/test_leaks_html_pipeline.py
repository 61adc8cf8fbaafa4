"""Decontamination, HTML extraction and the pipeline."""
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rivulet.llm import decontaminate, html_extract, packing
from rivulet.llm.queries import QUERIES

MIDDLE = "/root/testdata/sf0.01"


# -- decontamination --

def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row


def test_edit_distance_to_a_prefix():
    rng = random.Random(1)
    for _ in range(100):
        a = [rng.randrange(4) for _ in range(rng.randrange(1, 9))]
        b = [rng.randrange(4) for _ in range(rng.randrange(0, 12))]
        row = levenshtein(a, b)
        edits, end = decontaminate.edit_distance(np.array(a), np.array(b, np.int64))
        assert edits == min(row) and row[end] == edits


def planted(seed=2):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 7)))
    items = [(i, " ".join(word() for _ in range(rng.randrange(8, 50)))) for i in range(20)]
    items += [(100, "too short item"), (101, None), (102, items[0][1])]
    docs, truth = [], set()
    for n in range(120):
        words = [word() for _ in range(rng.randrange(20, 200))]
        if n % 2:
            i, text = items[rng.randrange(20)]
            own = text.split()
            for _ in range(rng.randrange(0, len(own) // 5 + 1)):
                at, what = rng.randrange(len(own)), rng.random()
                if what < 0.4:
                    own[at] = word()
                elif what < 0.7 and len(own) > 1:
                    del own[at]
                else:
                    own.insert(at, word())
            at = rng.randrange(len(words))
            words[at:at] = [w.upper() + "%%%" for w in own]
            truth.add((n, i))
            if i == 0:
                truth.add((n, 102))
        docs.append((n, ", ".join(words)))
    return items, docs + [(500, None), (501, ""), (None, "x " + items[1][1])], truth | {(None, 1)}


def brute_hits(items, docs):
    """(doc, item) within the allowed edits of some run of words."""
    out = set()
    words = lambda t: re.findall(r"[0-9a-z]+", (t or "").lower())
    for i, text in items:
        own = words(text)
        if len(own) < decontaminate.LEAST:
            continue
        allowed = len(own) * 20 // 100
        for d, body in docs:
            rest = words(body)
            row = [0] * (len(rest) + 1)
            for k, x in enumerate(own, 1):  # edit distance to any run: free start and end
                new = [k]
                for j, y in enumerate(rest, 1):
                    new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
                row = new
            if min(row) <= allowed:
                out.add((d, i))
    return out


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 2000])
def test_hits_reach_the_recall(spark, block_bytes):
    items, docs, _ = planted()
    frame = spark.createDataFrame([(d, t, 3, 4) for d, t in docs], "doc_id long, text string, item_id int, begin int")
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    rows = decontaminate.find_passages(spark, frame, bench, block_bytes=block_bytes).collect()
    exact, got = brute_hits(items, docs), {(r["doc_id"], r["item_id"]) for r in rows}
    assert got <= exact and len(got) >= 0.97 * len(exact)
    kept = decontaminate.drop_contaminated(spark, frame, bench, block_bytes=block_bytes)
    assert kept.columns == frame.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in got}
    assert decontaminate.find_passages(spark, frame.limit(0), bench).count() == 0
    assert decontaminate.find_passages(spark, frame, bench.limit(0)).count() == 0


def test_recall_at_the_allowed_distance():
    rng = np.random.default_rng(3)
    words = [rng.integers(1, 1 << 60, n, dtype=np.uint64) for n in rng.integers(10, 60, 40)]
    index = decontaminate.Index([])
    index = decontaminate.Index([(i, " ".join(f"w{x}" for x in w)) for i, w in enumerate(words)])
    found = 0
    for trial in range(300):
        k = trial % 40
        own = index.words[k].tolist()
        for _ in range(int(index.edits[k])):
            at, what = int(rng.integers(len(own))), rng.random()
            if what < 0.34:
                own[at] = int(rng.integers(1, 1 << 60))
            elif what < 0.67:
                del own[at]
            else:
                own.insert(at, int(rng.integers(1, 1 << 60)))
        text = np.concatenate([rng.integers(1, 1 << 60, 30, dtype=np.uint64), np.array(own, np.uint64), rng.integers(1, 1 << 60, 30, dtype=np.uint64)])
        found += any(item == k for item, *_ in index.hits(text))
    assert found >= 0.97 * 300


def test_verbatim_passages_of_the_tables(spark):
    bench = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{MIDDLE}/benchmark.parquet").collect()}
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()}
    hits = QUERIES["op3_decontaminate"](spark, MIDDLE).collect()
    assert {(d, i) for d, t in docs.items() for i, b in bench.items() if b in t} <= {(h["doc_id"], h["item_id"]) for h in hits}
    for h in hits:
        part = docs[h["doc_id"]].encode()[h["begin"]:h["end"]].decode()
        assert h["edits"] <= h["item_words"] * 0.2 and (h["edits"] or part.split()[0].lower()[:3] == bench[h["item_id"]].split()[0].lower()[:3])


# -- HTML --

def text_of(page):
    return " ".join(words for words, *_ in html_extract.parse(page)[0])


@pytest.mark.parametrize("page, text", [
    ("<div>a<p>b<b>c</p>d</div><script>x='</p>'</script><!-- z -->e &amp; f&nbsp;g", "a bc d e & f g"),
    ("<body><div class='sidebar'>S</div><main><h1>T</h1><p>x<p>y<ul><li>1<li>2</ul><section class=comments><p>no</section></main><p>after", "T x y 1 2"),
    ("<p>un\"closed <a href=\"x>t</a> q", "un\"closed t q"),
    ("a < b and c", "a < b and c"), ("<style>p{}", ""), ("<!-- open", ""), ("", ""), ("plain  \n text", "plain text"),
    ("<div id='cookie-notice'>c</div><p>k</p><form><p>f</p></form>z", "k z"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1 2 3"),
    ("<article><header><h1>H</h1></header><p>b</p><footer>f</footer></article><aside>s</aside>", "H b"),
    ("<p>&lt;b&gt; &#233;&#x41;&copy</p>", "<b> éA©"), ("<DIV HIDDEN>h</DIV><P>v</P>", "v"),
    ("<p>" * 3000 + "deep", "deep"), ("<div>" * 3000 + "deep", "deep"),
])
def test_parse(page, text):
    assert text_of(page) == text


def test_style_tree_removes_what_a_site_repeats(spark):
    def page(n, host="h.example"):
        return (n, f"https://{host}/{n}", "<body><div class=top>Welcome to our lovely site</div><div class=list>"
                + "".join(f"<a href=/{k}>Story {k} of {n}</a> " for k in range(5))
                + f"</div><div class=story><p>Text number {n} of the page.</p><p>More {n * 7} here.</p></div></body>", "clash")
    rows = [page(n) for n in range(12)] + [page(n, "few.example") for n in range(100, 102)] + [page(3)]
    rows += [(n, "https://same.example/", "<div class=x><p>All pages alike.</p></div>", "clash") for n in range(200, 220)]
    rows += [(300, None, None, "c"), (301, "not a url", "", "c"), (None, "https://h.example/z", page(400)[2], "c")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = html_extract.extract(spark, frame).collect()
    text = {r["page_id"]: r["text"] for r in got}
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    assert text[3] == "Text number 3 of the page. More 21 here." and text[None] == "Text number 400 of the page. More 2800 here."
    assert text[100].startswith("Welcome") and text[205] == "All pages alike." and text[300] == text[301] == ""
    assert html_extract.extract(spark, frame.limit(0)).count() == 0


def test_articles_of_the_tables(spark):
    import html as html_lib

    pages = {r["page_id"]: r for r in spark.read.parquet(f"{MIDDLE}/pages.parquet").collect()}
    for r in QUERIES["op9_html_extract"](spark, MIDDLE).collect():
        body = re.search(r"<article>(.*)</article>", pages[r["page_id"]]["html"], re.S)[1]
        body = re.sub(r"</?b>", "", body)
        want = " ".join(html_lib.unescape(re.sub(r"<[^>]+>", " ", body)).split())
        assert r["text"] == want and r["url"] == pages[r["page_id"]]["url"]


# -- pipeline --

def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "suffix_dedup", "decontaminate", "packing"]


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_each_stage_on_its_input(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    given = {r["doc_id"]: r for r in docs.collect()}
    kept = stage("language_id")(spark, docs, MIDDLE)
    assert kept.schema == docs.schema and kept.count() >= 0.98 * docs.count()

    near = stage("near_dedup")(spark, docs, MIDDLE)
    from rivulet.llm.near_dedup import near_duplicates
    want = {r["doc_id"] for r in near_duplicates(spark, docs).collect() if r["kept"]}
    assert near.schema == docs.schema and {r["doc_id"] for r in near.collect()} == want and len(want) < docs.count()

    cut = {r["doc_id"]: r for r in stage("suffix_dedup")(spark, docs, MIDDLE).collect()}
    assert set(cut) == set(given)
    first = {}
    for d in sorted(given):
        data = given[d]["text"].encode()
        repeats = []
        for s in range(len(data) - 99):
            if first.setdefault(data[s:s + 100], (d, s)) != (d, s):
                repeats.append(s)
        assert (cut[d]["text"] == given[d]["text"]) == (not repeats) and cut[d]["n_chars"] == len(cut[d]["text"])
        assert cut[d]["lang"] == given[d]["lang"] and cut[d]["source"] == given[d]["source"]

    clean = {r["doc_id"] for r in stage("decontaminate")(spark, docs, MIDDLE).collect()}
    bench = [r["text"] for r in spark.read.parquet(f"{MIDDLE}/benchmark.parquet").collect()]
    leaked = {d for d, r in given.items() if any(b in r["text"] for b in bench)}
    assert leaked and not leaked & clean and len(clean) >= len(given) - len(leaked) - 2


def test_run_packs_what_the_stages_keep(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, small)
    want = {r["doc_id"]: len(packing.token_ids(r["text"] or "")) for r in docs.collect()}
    got = {}
    for r in corpus_pipeline.run(spark, small).collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
        assert r["doc_tokens"] == want[r["doc_id"]]
    assert got == want


def test_stages_with_odd_rows(spark, small):
    rows = [(1, "the of and " * 30, "en", "s", 5, "kept"), (1, "the of and " * 30, "en", "s", 5, "kept"), (2, None, None, None, None, None),
            (3, "", "en", "s", 0, "x"), (None, "the that with " * 20, "en", None, None, "y"), (4, "der die das und " * 40, "de", "s", 1, "z"),
            (5, "%% 12", "en", "s", 1, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string")
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, docs, small)
        assert out.columns == docs.columns and function(spark, docs.limit(0), small).count() == 0
        ids = sorted(str(r["doc_id"]) for r in out.collect())
        assert ids == {"language_id": ["1", "1", "4", "None"], "near_dedup": ["1", "2", "3", "4", "5", "None"],
                       "suffix_dedup": ["1", "1", "2", "3", "4", "5", "None"], "decontaminate": ["1", "1", "2", "3", "4", "5", "None"]}[name]
    assert stage("packing")(spark, docs, small).select(F.countDistinct("doc_id")).first()[0] == 5


def test_pages_of_one_id_are_cut_each_by_their_own_host(spark):
    page = lambda k: f"<body><div class='x'>same on all</div><div class='y'><p>own words {k} {k * k} of this page</p></div></body>"
    rows = [(None, f"http://a.example/{k}", page(k)) for k in range(8)]
    # A host with nothing to compare keeps the branch that the other host's tree drops.
    rows += [(None, "http://b.example/0", page(99))]
    got = {r["url"]: r["text"] for r in html_extract.extract(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == 9 and got["http://b.example/0"].startswith("same on all")
    assert all(not got[f"http://a.example/{k}"].startswith("same") for k in range(8))


def test_very_deep_and_very_long_pages(spark):
    """Fifty thousand open tags, each with a text, and pages of one deep host whose shared branch goes."""
    deep = "".join(f"<div>x{i} " for i in range(50_000))
    blocks, nodes = html_extract.parse(deep)
    assert len(blocks) == 50_000 and len(nodes) == 50_000
    inline = "<p>" + "<span>y " * 50_000 + "</nothing>" * 50_000
    assert len(html_extract.parse(inline)[0]) == 1
    long = "<p>" + "word " * 400_000 + "</p>"
    rows = [(1, "http://deep/1", deep), (2, "http://long/2", long), (3, "http://spans/3", inline)]
    got = {r["page_id"]: r["text"] for r in html_extract.extract(
        spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == " ".join(f"x{i}" for i in range(50_000)) and got[2] == " ".join(["word"] * 400_000)
    assert got[3] == " ".join(["y"] * 50_000)


def test_sums_over_the_tree(spark):
    """Importance, link shares and pages of each node against a plain walk up from every leaf."""
    import math
    from collections import defaultdict
    rnd = random.Random(4)
    pages = []
    for i in range(12):
        inner = "".join(f'<div class="{rnd.choice("abcd")}"><p>{rnd.choice(["same", f"own {i} {rnd.random()}"])}</p>'
                        f'<ul><li>one</li><li><a href="#">{rnd.choice(["link", "other"])}</a></li></ul></div>' for _ in range(rnd.randint(1, 5)))
        pages.append(f"<body><section><div class=x>{inner}</div></section></body>")
    own, looks, up_of = defaultdict(lambda: defaultdict(dict)), defaultdict(lambda: defaultdict(set)), {}
    for page in pages:
        blocks, nodes = html_extract.parse(page)
        name, leaves = html_extract._hash("\0".join(b[0] for b in blocks)), defaultdict(list)
        for words, node, links in blocks:
            leaves[node.path].append((words, links))
            up = []
            while node is not None:
                up.append(node.path)
                node = node.parent
            up_of[up[0]] = up
        for path, found in leaves.items():
            own[path]["\0".join(w for w, _ in found)][name] = (sum(len(w) for w, _ in found), sum(k for _, k in found))
        for node in nodes:
            looks[node.path][" ".join(html_extract._runs(node.children))].add(name)

    def variety(counts):
        total = sum(counts)
        return 1.0 if total <= 1 else -sum(n / total * math.log(n / total) for n in counts) / math.log(total)
    below = defaultdict(list)
    for path, contents in own.items():
        chars, links = (sum(v[k] for pages_of in contents.values() for v in pages_of.values()) for k in (0, 1))
        for p in up_of[path]:
            below[p].append((variety([len(v) for v in contents.values()]), chars, links, sum(map(len, contents.values()))))
    want = {}
    for path, leaves in below.items():
        content = sum(v * c for v, c, *_ in leaves) / sum(c for _, c, *_ in leaves)
        weight = html_extract.DECAY ** len(leaves)
        shape = variety([len(v) for v in looks[path].values()]) if path in looks else 0.0
        want[html_extract.signed(path)] = (max(content, (1 - weight) * shape + weight * content),
                                           sum(k for *_, k, _ in leaves) / sum(c for _, c, *_ in leaves), max(n for *_, n in leaves))
    tree = html_extract.style_tree(spark, spark.createDataFrame([("h", p) for p in pages], "host string, html string")).collect()
    assert {r["path"] for r in tree} == set(want)
    for r in tree:
        assert (r["importance"], r["link_share"], r["n_pages"]) == pytest.approx(want[r["path"]], abs=1e-9)
