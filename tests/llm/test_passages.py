"""Tiling, HTML extraction and the pipeline against brute force."""

import html
import random
import re

import numpy as np
import pytest
from admetrics.llm import html_text, tiling
from conftest import SF_DIR
from llm_fixtures import docs  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline


def brute_tiles(item, doc, least):
    taken_p, taken_d, out = [0] * len(item), [0] * len(doc), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and not taken_p[i + n] and not taken_d[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return out
        out.append((i, j, n))
        for k in range(n):
            taken_p[i + k] = taken_d[j + k] = 1


def test_tiles_equal_brute_force():
    rng = random.Random(2)
    for _ in range(300):
        letters = rng.choice(["ab", "abcdefg"])
        item = [rng.choice(letters) for _ in range(rng.randint(1, 25))]
        doc = [rng.choice(letters) for _ in range(rng.randint(0, 25))]
        cut = rng.randint(0, len(item))
        doc += rng.choice([[], item[cut:] + item[:cut]])
        least = rng.choice([2, 3, 5])
        assert sorted(tiling.tiles(item, doc, least)) == sorted(brute_tiles(item, doc, least))


def test_pairs_equal_brute_force(spark, docs):  # noqa: F811
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(6, 40)))) for i in range(12)] + [(50, None), (51, "too short"), (40, None), (52, "")]
    items[-2] = (40, items[0][1])
    texts = [None, "", "w1 w2", "W1, " * 30_000]
    for _, text in items[:8]:
        w = text.split()
        texts += [" ".join(rng.choices(words, k=30)) + " " + text.upper(), " ".join(w[len(w) // 2 :] + ["x"] + w[: len(w) // 2]), " ".join(w[:6])]
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, texts[5]), (None, texts[4]), (99, texts[4])]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = tiling.pairs(docs(*rows), benchmark).select("doc_id", "item_id", "n_covered", "coverage").collect()
    want = set()
    for doc_id, text in rows:
        for item_id, item in items[:12]:
            p, d = tiling.tokens_of(item), tiling.tokens_of(text)
            covered = sum(x[2] for x in brute_tiles(p, d, 5)) if len(d) < 1000 else 0
            if covered:
                want.add((doc_id, item_id, covered, covered / len(p)))
    assert set(map(tuple, found)) == want and len(found) == len(want)
    flagged = {r.doc_id for r in tiling.contaminated(docs(*rows), benchmark).collect()}
    assert {4, 5, 7, 8, None, 99} <= flagged and not {0, 1, 2, 3} & flagged
    frame = docs(*rows).selectExpr("*", "'d' AS digest", "1 AS row", "'s' AS seeds")
    clean = tiling.decontaminate(frame, benchmark)
    assert clean.columns == frame.columns and {r.doc_id for r in clean.collect()} == {r[0] for r in rows} - flagged
    assert tiling.pairs(docs(*rows), benchmark.limit(0)).count() == 0
    assert tiling.pairs(docs().limit(0), benchmark).count() == 0


@pytest.mark.parametrize(
    "page, text",
    [
        # Readers' comments and teasers around and inside an article.
        ('<article><p>Own text.</p></article><div id="comments"><ol class="comment-list"><li class="comment"><article class="comment-body"><p>A reader.</p></article></li></ol></div>', "Own text."),
        ('<article><p>Own.</p></article><div id="comments"><ol><li><article><p>A reader.</p></article></li></ol></div>', "Own."),
        ('<main><article><p>Own.</p></article><section class="related"><article>Teaser</article></section><div class="sidebar"><article>Other</article></div></main>', "Own."),
        ('<div class="sidebar"><article>Teaser</article></div><main><article><p>Own.</p></article></main>', "Own."),
        ('<article><p>Own.</p><section class="article-comments"><p>c1</p></section><div class="comment-body">c2</div><div class="user-comments">c3</div></article>', "Own."),
        ('<div class="no-comments"><article class="comments-open"><p>Own.</p><p class="commentary">More.</p></article></div>', "Own.\nMore."),
        ('<div class="widget"><article><p>One.</p></article><article><p>Two.</p></article></div>', "One.\nTwo."),
        ('<form><article><p>Own.</p></article></form>', "Own."),
        # A script inside a paragraph does not end it.
        ("<article><p>one<script>x</script>two</p><p>a <style>b{}</style> c</p></article>", "onetwo\na c"),
    ],
)
def test_main_text_of_markup(spark, page, text):
    frame = spark.createDataFrame([(1, "http://a.org/1", page)], "page_id bigint, url string, html string")
    assert html_text.extract(frame).first().text == text


def test_short_items_and_scripts_without_spaces(spark, docs):  # noqa: F811
    clause = "春眠不觉晓处处闻啼鸟夜来风雨声花落知多少又一年春天"
    items = [(1, "To be or not"), (2, clause), (3, "x"), (4, "ภาษาไทยไม่มีช่องว่าง"), (5, "not or be to")]
    rows = [(1, "He said: to be, or NOT! And left."), (2, f"他说{clause}然后走了"), (3, "to be or"), (4, "a X b"), (5, clause[:10]), (6, "พูดว่าภาษาไทยไม่มีช่องว่างครับ")]
    found = tiling.contaminated(docs(*rows), spark.createDataFrame(items, "item_id bigint, text string"))
    assert {(r.doc_id, r.item_id, r.coverage) for r in found.collect()} == {(1, 1, 1.0), (2, 2, 1.0), (4, 3, 1.0), (6, 4, 1.0)}


def test_a_common_phrase_is_not_tiled(spark, docs):  # noqa: F811
    """Pairs that share a phrase alone end before their texts are joined; the results are those of all pairs."""
    rng = random.Random(9)
    draw = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    items = [(i, f"{draw(10)} in the course of the year {draw(10)}") for i in range(60)]
    rows = [(i, f"{draw(20)} in the course of the year {draw(20)}") for i in range(400)] + [(1000 + i, f"{draw(5)} {items[i][1]} {draw(5)}") for i in range(5)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    frame = docs(*rows)
    found = tiling.contaminated(frame, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1000 + i, i) for i in range(5)} and {r.coverage for r in found} == {1.0}
    assert tiling.pairs(frame, benchmark, coverage=tiling.COVERAGE).count() == 5
    few = frame.where("doc_id >= 390")
    whole = tiling.pairs(few, benchmark)
    assert whole.count() == 15 * 60 and whole.where(F.col("coverage") >= tiling.COVERAGE).count() == 5


@pytest.mark.parametrize(
    "page,content,others",
    [
        (None, None, []),
        ("<p>a<b>b</b>\n c<br>d<p>e", None, ["ab c d", "e"]),
        ("<article><header><h1>T</h1></header><p>x &amp y &lt;z</p><div class='comments'><p>no</p></div><p>y</article><footer>f</footer>", "T\nx & y <z\ny", ["no", "f"]),
        ('<div id="cookie-notice">hi</div><ul><li>one<li>two</ul><script>x="</p>"</script><form>q</form>', None, ["hi", "one", "two", "q"]),
        ("a < b and <3 <a title=\"x>y\">L</a> <!-- c --> z<!-- open", None, ["a < b and <3 L z"]),
        ("<main>Text<aside>s</aside></main>", "Text", ["s"]),
        ("<noscript><p>n</p></noscript><svg><text>q</text></svg>ok<style>p{}", None, ["ok"]),
        ('<p title="unclosed>a<p>b</p><', None, ["a", "b", "<"]),
        ("<" * 5000 + "x", None, ["<" * 5000 + "x"]),
    ],
)
def test_blocks(page, content, others):
    found, _, texts = html_text.parse(page)
    assert (found, texts) == (content, others)


def test_suffix_intervals_equal_brute_force():
    rng = random.Random(6)
    streams = [[rng.choice("abc") for _ in range(rng.randint(0, 30))] for _ in range(8)]
    value, n = html_text.suffix_intervals(streams, 4)
    got = dict(zip(value.tolist(), n.tolist()))
    want = {}
    for k, tokens in enumerate(streams):
        for i in range(len(tokens) - 3):
            key = int(html_text._windows(tokens[i : i + 4], 4)[0])
            want.setdefault(key, set()).add(k)
    assert got == {k: len(v) for k, v in want.items()}
    keys = np.array([rng.randrange(-9, 9) for _ in streams])
    value, n, first = html_text.suffix_intervals(streams, 4, keys)
    assert dict(zip(value.tolist(), first.tolist())) == {k: min(keys[list(v)]) for k, v in want.items()}
    for none in ([], [[]], [["a"], []]):
        assert [len(x) for x in html_text.suffix_intervals(none, 4, np.zeros(len(none), np.int64))] == [0, 0, 0]


@pytest.mark.parametrize("least", [1, 2, 3, 5, 8, 24])
def test_suffix_array_equals_sorted_suffixes(least):
    rng = random.Random(least)
    for n in (0, 1, 2, 7, 60, 150):
        symbols = [rng.randrange(2) for _ in range(n)]
        array, shared = html_text.suffix_array(np.array(symbols, np.int64), least)
        assert array.tolist() == sorted(range(n), key=lambda i: symbols[i:])
        heads = [symbols[i : i + least] for i in array]
        assert shared.tolist() == [k > 0 and len(heads[k]) == least and heads[k] == heads[k - 1] for k in range(n)]


def plain_texts(rows, run, min_pages, share):
    """The text of each row by page_id, from sets of token tuples over whole hosts."""
    parsed = {i: (url.split("/")[2], html_text.parse(page)) for i, url, page in rows}
    by_host = {}
    for host, (content, kinds, texts) in parsed.values():
        if texts:
            by_host.setdefault(host, set()).add((content, tuple(kinds), tuple(texts)))

    def streams(texts):
        tokens = " ".join(texts).split(" ")
        return {("block", t) for t in texts} | {tuple(tokens[k : k + run]) for k in range(len(tokens) - run + 1)}

    def all_in(texts, repeats):
        tokens = " ".join(texts).split(" ")
        covered, out, at = [False] * len(tokens), [], 0
        for k in range(len(tokens) - run + 1):
            if tuple(tokens[k : k + run]) in repeats:
                covered[k : k + run] = [True] * run
        for t in texts:
            n = len(t.split(" "))
            out.append(("block", t) in repeats or all(covered[at : at + n]))
            at += n
        return out

    out = {}
    for i, (host, (content, kinds, texts)) in parsed.items():
        if content is not None:
            out[i] = {content}
            continue
        contents = by_host.get(host, set())
        counts = {}
        for c in contents:
            for x in streams(c[2]):
                counts[x] = counts.get(x, 0) + 1
        repeats = {x for x, n in counts.items() if n >= min_pages and n >= share * len(contents)}
        is_open = [k == html_text.OPEN for k in kinds]
        gone = [a and b for a, b in zip(is_open, all_in(texts, repeats))] if texts else []
        size = [len(t.split(" ")) for t in texts]
        # Long repeats stay with one content only, so a row may have them or not.
        copied = 2 * sum(n for n, g in zip(size, gone) if g) > sum(n for n, o in zip(size, is_open) if o)
        sure = [t for t, o, g in zip(texts, is_open, gone) if o and not g]
        first = [t for t, o, g, n in zip(texts, is_open, gone, size) if o and (not g or copied or n >= run)]
        opened = "\n".join(t for t, o in zip(texts, is_open) if o)
        out[i] = {"\n".join(sure) or opened, "\n".join(first) or opened}
    return out


def test_extract_equals_sets_of_runs_over_whole_hosts(spark):
    """All of the query's path, on hosts with and without marked content, in one shard and many."""
    rng = random.Random(12)
    words = [f"w{i}" for i in range(400)]
    notice = " ".join(rng.choices(words, k=70))
    rows = []
    for i in range(90):
        host = rng.choice(["a.com", "b.com", "c.com"])
        own = "".join(f"<p>{' '.join(rng.choices(words, k=rng.randint(3, 40)))}</p>" for _ in range(3))
        cut = rng.randint(0, 30)
        more = f"<div>{' '.join(notice.split()[cut:])}</div>" if rng.random() < 0.8 else ""
        body = f"<div>{host} short words</div>{own}{more}<nav>menu of {host}</nav>"
        if rng.random() < 0.2:
            body = f"<article>{body}</article>{more}"
        rows.append((i, f"http://{host}/{i}", body))
    rows.append((90, "http://a.com/90", rows[0][2]))
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    want = plain_texts(rows, html_text.RUN, html_text.PAGES, html_text.SHARE)
    found = {n: {r.page_id: r.text for r in html_text.extract(pages, shard=n).collect()} for n in (10**6, 90)}
    assert found[90] == found[10**6]
    assert all(found[90][i] in want[i] for i in want) and len(found[90]) == len(rows)
    # The runs matter: some pages lose a notice that is no whole block of others.
    assert sum(notice.split()[-1] in found[90][i] for i in range(90)) < sum(notice.split()[-1] in r[2] for r in rows)


def site(rng, n):
    words = [f"w{i}" for i in range(3000)]
    for i in range(n):
        host = rng.choice(["a.com", "b.com", "big.com", "big.com"])
        body = "".join(f"<p>{' '.join(rng.choices(words, k=rng.randint(5, 30)))}</p>" for _ in range(4))
        yield i, f"http://{host}/{i}", f"<div>Welcome to {host} the best site</div>{body}<div>We use many crumbs here ok</div>"


def test_boilerplate_goes_whatever_the_shards(spark):
    rows = [*site(random.Random(4), 60), (100, None, None), (101, "http://solo.com/", "<p>only page here</p>"), (101, "http://solo.com/", "<p>only page here</p>")]
    rows += [(None, "x", "<div>hello</div>"), (102, "http://a.com/", "<article>Welcome to a.com the best site</article>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    whole, cut = (sorted(map(tuple, html_text.extract(pages, shard=n).collect()), key=repr) for n in (10**6, 60))
    assert whole == cut and len(whole) == len(rows)
    for page_id, _, text in whole:
        if page_id is not None and page_id < 100:
            assert text.count("\n") == 3 and "Welcome" not in text and "crumbs" not in text
    texts = {r[0]: r[2] for r in whole}
    assert (texts[100], texts[101], texts[None], texts[102]) == ("", "only page here", "hello", "Welcome to a.com the best site")
    assert html_text.extract(pages.limit(0)).count() == 0


def test_articles_of_the_test_pages(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    got = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    for row in pages.collect():
        inside = re.search(r"<article>(.*)</article>", row.html, re.S)[1].replace("<br>", " ")
        plain = [html.unescape(re.sub("<[^>]*>", "", part)) for part in re.split(r"</?(?:p|h1)>", inside)]
        assert got[row.page_id] == "\n".join(" ".join(part.split()) for part in plain if part.split())
    assert len(got) == pages.count()


def test_pipeline(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs = table
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF_DIR)
        assert kept.columns == table.columns, name
        docs = spark.createDataFrame(kept.collect(), table.schema)
        assert 0 < docs.count() <= table.count()
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in found) == sorted(r.doc_id for r in docs.collect())
    assert all(len(r.ids_sha256) == len(r.decoded_sha256) == 64 and r.n_tokens > 0 for r in found)


def test_pipeline_of_odd_rows(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, None, "xx", None, 5)], table.schema)
    docs = table.union(odd).union(table.limit(3))
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, table.limit(0), SF_DIR)
        assert empty.count() == 0, name
        docs = spark.createDataFrame(stage(spark, docs, SF_DIR).collect(), docs.schema) if name != "BPE encoding" else stage(spark, docs, SF_DIR)
    assert docs.count() == docs.select("doc_id").distinct().count() > 0
    assert np.all([r.n_tokens > 0 for r in docs.collect()])


def test_repeats_need_length_and_a_share_of_the_host(spark):
    """Common word runs on a large host, copies of a page, and near-copies lose no text; a notice on most pages goes."""
    rng = random.Random(9)
    few = [f"w{i}" for i in range(12)]
    notice = "<div>All prices include tax in this shop</div>"
    bodies = ["".join(f"<p>{' '.join(rng.choices(few, k=rng.randint(6, 12)))} {i} {k}</p>" for k in range(3)) for i in range(400)]
    rows = [(i, f"http://big.com/{i}", notice + b) for i, b in enumerate(bodies)]
    rows += [(1000 + i, f"http://big.com/copy{i}", notice + bodies[0]) for i in range(300)]
    rows += [(2000 + i, f"http://two.com/{i}", "<p>one text under two addresses</p>") for i in range(2)]
    long = [" ".join(f"near{j}x{k}" for k in range(40)) for j in range(2)]
    rows += [(3000 + i, f"http://near.com/{i}", f"<p>{long[0]}</p><p>{long[1]}</p><p>seen {i} times</p>") for i in range(4)]
    rows += [(4000 + i, f"http://same.com/{i}", "".join(f"<p>{t}</p>" for t in rng.sample(["only a part", "another part", "third part"], 3))) for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    whole, cut = ({r.page_id: r.text for r in html_text.extract(pages, shard=n).collect()} for n in (10**6, 300))
    assert whole == cut and len(whole) == len(rows)
    for page_id, _, page in rows[:700]:
        assert whole[page_id] == "\n".join(re.findall("<p>(.*?)</p>", page))
    assert whole[2000] == whole[2001] == "one text under two addresses"
    assert sum(long[0] in whole[3000 + i] and long[1] in whole[3000 + i] for i in range(4)) == 1
    assert all(f"seen {i} times" in whole[3000 + i] for i in range(4))
    assert all(whole[4000 + i].count("\n") == 2 for i in range(6))


@pytest.mark.parametrize(
    "page,content",
    [
        ('<div class="has-sidebar"><article><p>all</p><div class="share">no</div></article></div>', "all"),
        ('<div class="no-ads" id="search-layout"><main class="search">all<form>no</form></main></div>', "all"),
        ('<div class="search"><form action="/x"><article>all</article></form></div>', "all"),
        ('<div class="comments"><main role="main"><div class="cookie-notice">no</div>all</main></div>', "all"),
        ("<aside><article>teaser</article></aside><form><article>one</article></form><article>two</article>", "one\ntwo"),
    ],
)
def test_labels_around_content_leave_it(page, content):
    assert html_text.parse(page)[0] == content


def test_labels_are_whole_tokens_and_never_hold_all():
    def kinds(page):
        return html_text.parse(page)[1]

    for label in ("has-sidebar", "no-ads", "search-layout", "download", "researchSearchers"):
        assert kinds(f'<div class="{label}">x</div><p>y</p>') == [html_text.OPEN] * 2
    for label in ("sidebar", "big ad", "cookie-notice", "site-footer", "cookieBanner"):
        assert kinds(f'<div class="{label}">x</div><p>y</p>') == [html_text.CHROME, html_text.OPEN]
    assert kinds('<form><div id="search">x<nav>n</nav></div></form>') == [html_text.OPEN, html_text.CHROME]
    assert kinds("<nav>n</nav>") == [html_text.OPEN]


def test_shards_count_pages_and_repeated_rows_once(spark):
    rows = [(None, i, [], []) for i in range(50)] + [(None, 7, [html_text.OPEN], ["same"])] * 200
    rows += [(None, 1000 + i, [html_text.OPEN], ["x"]) for i in range(100)]
    rows = [("", *r) for r in rows]
    parsed = spark.createDataFrame(rows, "host string, content string, key bigint, kinds array<int>, texts array<string>")
    contents = html_text.open_contents(parsed)
    assert sorted(r.key for r in contents.collect()) == [7, *range(1000, 1100)]
    assert [tuple(r) for r in html_text.host_sizes(contents, 80).collect()] == [("", 101, 11)]


def notices(n, hosts=("a.com",)):
    """Pages with a main, of which most hold the same unlabelled notices, one as a run inside blocks of their own."""
    rng = random.Random(21)
    words = [f"w{i}" for i in range(500)]
    run = " ".join(f"r{k}" for k in range(30))
    for i in range(n):
        own = [" ".join(rng.choices(words, k=rng.randint(4, 30))) for _ in range(3)]
        extra = ["Orders leave our store on Mondays", run + " " + run.split()[-1] * (i % 2)] if i % 5 else []
        yield i, f"http://{hosts[i % len(hosts)]}/{i}", own, extra


def test_repeats_inside_a_main_go_and_an_article_stays_whole():
    for marked in ("main", "article"):
        kinds, texts = html_text.judged(f"<nav>n</nav><{marked}><p>own</p><p>notice</p></{marked}><p>more</p>")
        kind = html_text.OPEN if marked == "main" else html_text.CONTENT
        assert (kinds, texts) == ([html_text.CHROME, kind, kind, html_text.CHROME], ["n", "own", "notice", "more"])


def test_all_pages_pass_through_the_array(spark):
    """Repeats inside a main and of articles count, and are the same from one shard, from shards with many contents and from shards with few."""
    hosts = ("a.com", "b.com")
    rows = list(notices(240, hosts))
    html_of = lambda tag, own, extra: f"<{tag}>" + "".join(f"<p>{t}</p>" for t in own + extra) + f"</{tag}>"
    # On b.com only pages with an article say what is repeated on the page that has none.
    pages = [(i, url, html_of("main" if "a.com" in url else "article", own, extra)) for i, url, own, extra in rows]
    bare = [" ".join(f"only{k}" for k in range(12)), "Orders leave our store on Mondays"]
    pages += [(900, "http://b.com/900", "".join(f"<p>{t}</p>" for t in bare))] + [(1000 + i, *pages[i][1:]) for i in range(0, 40)]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(5)
    found = [
        {r.page_id: r.text for r in html_text.extract(frame, shard=shard, dense=dense).collect()} for shard, dense in ((10**6, 64), (2500, 5), (2500, 10**6), (90, 64))
    ]
    assert all(f == found[0] for f in found) and len(found[0]) == len(pages)
    for i, url, own, extra in rows:
        assert found[0][i] == "\n".join(own + (extra if "b.com" in url else [])).strip() or "a.com" in url
        if "a.com" in url:
            assert found[0][i].split("\n")[:3] == own and "Mondays" not in found[0][i]
    # The long one stays in one place.
    assert 1 <= len({found[0][i] for i, url, _, extra in rows if "a.com" in url and "r29" in found[0][i]}) <= 2
    assert found[0][900] == bare[0]


def test_values_of_a_share_of_the_contents_are_those_of_the_whole_array():
    rng = random.Random(6)
    common = [f"c{k}" for k in range(9)]
    streams = [rng.choices("abc", k=rng.randint(0, 30)) + (common if i % 3 else []) for i in range(30)]
    keys = np.arange(30)[::-1].copy()
    value, n, first = html_text.suffix_intervals(streams, 4, keys)
    for least in (2, 15, 31):
        got = html_text.suffix_intervals(streams, 4, keys, least)
        assert [x.tolist() for x in got] == [x[n >= least].tolist() for x in (value, n, first)]
