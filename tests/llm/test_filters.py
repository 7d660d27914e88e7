"""Quality rules and URL rules against brute force, and all SQL oracles of the subpackage."""

import re
from collections import Counter

import pytest
from admetrics.llm import quality_rules, queries, url_filters
from compare import connect, differences
from conftest import SF_DIR
from llm_fixtures import docs  # noqa: F401


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_oracle(spark, name):
    assert differences(spark, connect(SF_DIR), SF_DIR, name) == []


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


TEXTS = [
    None, "", " \n\t", "one", "a b c d e a b c d e", "a a a a a a a", "x y z\nx y z\n \n\nx y z", "| # * $ % & < > ||", "é\xa0ü word\x85more 日本",
    "a b c d e f " * 3 + "tail", "the of and to in a is that it for was on as with be " * 2, "w" * 5000, " ".join(map(str, range(3000))) + " 5 6 7 8 9 10",
    "THE the The der die das le la", "\n".join(["same line of words here"] * 9), "p q r s t u q r s t u v",
]


def test_counts_equal_brute_force(spark, docs):  # noqa: F811
    frame = docs(*TEXTS, (0, None), (None, "a b")).selectExpr("doc_id", "text", "'z' AS words", "7 AS n_words", "1 AS _measures", "2 AS kept")
    found = quality_rules.judge(frame).collect()
    assert len(found) == len(TEXTS) + 2
    for r in found:
        want = brute_counts(r.text)
        assert {k: r[k] for k in want} == want, r.text
        assert r.base_failed == (want["n_words"] < 10 or 100 * want["n_repeat_words"] > 20 * want["n_words"])
        assert not (r.kept and r.base_failed) and r.kept == (not r.failed_rules)
    assert quality_rules.judge(docs().limit(0)).count() == 0


def test_keep_good_returns_its_columns(spark, docs):  # noqa: F811
    good = "The cat of the house and the dog sat in it, for that was what they had to do with us."
    frame = docs(good, "bad " * 50, None, good).selectExpr("*", "1 AS row", "2 AS n_words")
    kept = quality_rules.keep_good(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3] and {r.n_words for r in kept.collect()} == {2}


RUSSIAN = "Вчера вечером мы долго гуляли по старому городу, смотрели на реку и говорили о том, как быстро проходит лето и что нас ждёт осенью. "
RUSSIAN += "Потом пошёл тёплый дождь, улицы опустели, а фонари отражались в лужах."
POLISH = "Wczoraj wieczorem długo spacerowaliśmy po starym mieście, patrzyliśmy na rzekę i mówiliśmy o tym, jak szybko mija lato. "
POLISH += "Potem zaczął padać ciepły deszcz, ulice opustoszały, a latarnie odbijały się w kałużach i nie było nikogo."
CHINESE = "昨天晚上我们在老城里散步。 " + " ".join("我们看着河水慢慢地流过第%d座古老而安静的石桥旁边" % i for i in range(40))


def test_clean_texts_of_other_languages_stay(spark, docs):  # noqa: F811
    """Rules that measure Latin scripts judge no other; symbols and repeats count in any script, and numbers are no script."""
    junk = ["| ".join(RUSSIAN.split()) + " #### $$$$", (RUSSIAN + "\n") * 3, " ".join(map(str, range(1000, 1060))), " ".join(f"qxv{i}zt" for i in range(60))]
    found = {r.doc_id: r for r in quality_rules.judge(docs(RUSSIAN, POLISH, CHINESE, *junk)).collect()}
    assert [found[i].failed_rules for i in range(3)] == [[], [], []]
    assert [found[i].failed_rules for i in range(3, 7)] == [["symbols"], ["repetitive", "repeated_lines"], ["stop_words"], ["stop_words"]]
    assert found[0].other_letter_ratio > 0.9 and found[1].other_letter_ratio == 0
    assert sorted(r.doc_id for r in quality_rules.keep_good(docs(RUSSIAN, POLISH, CHINESE, *junk)).collect()) == [0, 1, 2]


def test_plan_is_one_projection(spark, docs):  # noqa: F811
    plan = quality_rules.judge(docs("x"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Arrow|Pandas", plan)


RULES = [
    *queries.URL_RULES, ("allow", "a.example.org", "/es/ok/"), ("block", "net", ""), ("block", "b.net", ""), ("allow", "x.org", "/a"),
    ("block", "org", "/a/bc"), ("block", "", "/everywhere"), ("block", "com", "/de/"),
]
URLS = [
    None, "", "no-scheme.org/", "http://", "http://org", "HTTP://EXAMPLE.ORG/es/x", "http://example.org/ES/x", "http://a.example.org/es/ok/1",
    "http://notexample.org/es/", "http://example.org/en/123?x#y", "http://example.org/en/2", "x://y.com/fr/", "http://y.com/de/://z.org/",
    "http://q.net#frag", "http://a.b.net?x", "http://x.org/a/bc", "http://..org/", "http://é.org/\n", "http://u@h.com:80/de/", "http://k.io/everywhere/1",
    "http://k.io/" + "p/" * 5000, "http://" + "s." * 500 + "com/de/",
]


def brute_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = re.split(r"[#?]", url.split("://", 1)[1])[0]
        host, slash, path = rest.partition("/")
        host, path = "".join(c.lower() if c.isascii() else c for c in host), slash + path
    fits = [r for r in RULES if (host == r[1] or host.endswith("." + r[1]) or r[1] == "") and path.startswith(r[2])]
    best = max(fits, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[0]), default=None)
    return host, path, best and best[1] + best[2], best[0] if best else "allow"


def test_url_rules_equal_brute_force(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, URLS[5]), (5, URLS[5]), (5, URLS[5])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string").selectExpr("*", "'h' AS host", "1 AS row", "2 AS short")
    rules = url_filters.rules_frame(spark, RULES)
    found = url_filters.judge_urls(pages, rules).select("page_id", "url", "host", "path", "rule", "verdict").collect()
    assert Counter(map(tuple, found)) == Counter((i, u, *brute_rule(u)) for i, u in rows)
    assert url_filters.judge_urls(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filters.judge_urls(pages, rules.limit(0), default="block").collect()} == {"block"}
    with pytest.raises(ValueError):
        url_filters.rules_frame(spark, [("block", "a.org", "x")])
