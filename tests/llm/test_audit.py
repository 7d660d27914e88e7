"""The filter interaction audit against a loop over documents, orders and steps."""

import re
from collections import Counter
from itertools import permutations

from admetrics.llm import filter_audit, queries
from conftest import SF_DIR


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(words) < 50,
        "B": 100 * len(set(words)) < 65 * len(words),
        "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
        "D": any(c in "#$%&*|" for c in text),
    }


def brute(docs, labels):
    """docs: (doc_id, text, source); labels: (doc_id, quality, toxic)."""
    least = {}
    for d, t, _ in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    good, toxic = ({d for d, *v in labels if v[i] == 1 and d is not None} for i in (0, 1))
    rows = []
    for d, t, s in docs:
        found = {f for f, no in fails(t or "").items() if no}
        if d is not None and d > least[t or ""]:
            found.add("E")
        rows.append((s or "", found, d in good, d in toxic))
    out = []
    for part in {r[0] for r in rows}:
        own, removed_by, lines = [r for r in rows if r[0] == part], Counter(), []
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                removed_by[f] += len(gone)
                redundant = sum(f in r[1] for r in own) - len(gone)
                line = (len(left), len(gone), redundant, sum(r[1] == {f} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone))
                lines.append((part, "".join(order), step, *line, f))
        out += [(*line[:-1], removed_by[line[-1]]) for line in lines]
    return sorted(out)


COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def rows(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def run(spark, docs, labels):
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, source string").selectExpr("*", "1 AS row", "'p' AS part", "2 AS key", "3 AS `set`")
    checked, tables = filter_audit.failing(frame)
    given = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").selectExpr("*", "5 AS row")
    marks = {m: filter_audit.labelled(checked, given.where(f"{c} = 1")) for m, c in (("good", "quality"), ("toxic", "toxic"))}
    return filter_audit.audit(checked, tables, marks)


def test_edge_rows(spark):
    many = " ".join(f"w{i}" for i in range(80))
    docs = [
        (1, many, "a"), (2, many, "a"), (3, many, None), (2, many, "a"), (None, many, "a"), (4, None, "a"), (5, "", "b"), (None, None, None), (6, "x # y", ""),
        (7, "LOUD " * 60, "b"), (8, many + " 100%", "b"), (9, "word " * 20_000, "c"), (10, "é\xa0É " + many, "c"), (11, many.upper(), "c"), (11, many.upper(), "c"),
    ]
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, 1), (7, 1, 1), (9, None, 1), (None, 1, 1), (99, 1, 1), (11, 1, None)]
    assert rows(run(spark, docs, labels)) == brute(docs, labels)
    assert rows(run(spark, docs, [])) == brute(docs, [])
    empty = run(spark, [], labels)
    assert empty.count() == 0 and set(empty.columns) == set(COLUMNS)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "source").collect()
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", "quality", "toxic").collect()
    assert rows(queries.op13_filter_audit(spark, SF_DIR)) == brute(docs, labels)


def test_joins_are_anti_and_semi(spark):
    frame = spark.createDataFrame([(1, "a", "s")], "doc_id bigint, text string, source string")
    checked, tables = filter_audit.failing(frame)
    plan = filter_audit.counts(checked, tables, {})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftAnti") == 2 and plan.count("LeftSemi") == 1 and "Cartesian" not in plan
