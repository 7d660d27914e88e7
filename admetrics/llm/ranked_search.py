"""Ranked lexical search: the no-random-access algorithm over impact-sorted lists.

Terms are the runs of characters that are neither ASCII punctuation, white space nor control characters, with A-Z lower-cased. A document's score
for an item is the sum, over the item's terms with repeats, of w * ((10^9 tf) div (1000 tf + 8 m)): w grows with the rarity of the term, m with
the document's length, all in 64-bit integers (`weights`, `impacts`).

The documents are read once into a forward table: a row per document with its length and the counts of the terms that occur in any item. Term
statistics cover all documents. Each task then takes chunks of whole documents, of bounded size, turns a chunk into one list per term sorted by
falling impact, and runs `no_random_access` for every item: all lists are read in step, block by block. What was read of a document is the lower end of
its score, and the upper end adds the next unread impact of every list in which it was not met. Documents whose upper end is below the k-th lower
end leave; reading goes on until no unread document can enter, and until every document that is left has met ends. As a document lies in one
chunk, the best k of all chunks hold the best k of the table; a row number per item, cut to k rows before it is shuffled, picks them.

The items are taken in blocks of at most `BLOCK_TERMS` rows of term and item (an item with more goes alone), and only a block's terms are
sent to the tasks; the number of blocks grows with the items.

Defined cases: null and empty texts, and texts without a term, have no terms: such documents are not counted and not found, such items have no rows.
Repeated documents are ranked each; repeated items have their rows each. Equal scores follow the id, null ids last. Documents without a score above 0 are
not returned, so an item may have fewer than k rows. No documents or no items give no rows. Texts are taken whole. Other columns are ignored.
"""

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from admetrics.session import materialize

#: Terms end at these bytes; every byte of a character beyond ASCII belongs to a term.
_ENDS = {*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)}
_FOLD = bytes(0x20 if b in _ENDS else b + 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))

#: Rows of (item, term) in a block of items.
BLOCK_TERMS = 200_000
#: Documents and postings of a chunk, and entries that the first round reads of each list.
CHUNK_DOCS, CHUNK_POSTINGS, FIRST_DEPTH = 32_768, 2_000_000, 1024


def terms(raw: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return raw.translate(_FOLD).split() if raw else []


def _texts(batch):
    return batch.column("_text").cast(pa.binary()).to_pylist()


def item_terms(items: DataFrame, text="text", item_id="item_id") -> DataFrame:
    """Stored rows (item, item_id, term, q): the counted terms of each numbered item."""

    def count(batches):
        for batch in batches:
            rows, found, counts = [], [], []
            for i, raw in enumerate(_texts(batch)):
                here: dict[bytes, int] = {}
                for term in terms(raw):
                    here[term] = here.get(term, 0) + 1
                rows += [i] * len(here)
                found += here.keys()
                counts += here.values()
            picked = batch.select(["item", "item_id"]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(found, pa.binary()), pa.array(counts, pa.int64())], ["item", "item_id", "term", "q"])

    numbered = items.select(F.monotonically_increasing_id().alias("item"), F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{text}`").alias("_text"))
    schema = f"item bigint, item_id {numbered.schema['item_id'].dataType.simpleString()}, term binary, q bigint"
    return materialize(numbered.mapInArrow(count, schema), "item-terms")


def blocks(counted: DataFrame, block_terms=BLOCK_TERMS):
    """The items' terms in blocks that fit in memory: dicts of item -> [(term, q), ...]."""
    n = max(1, -(-counted.count() // block_terms))
    while True:
        dealt = counted.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(n)))
        most = dealt.groupBy("block").agg(F.count(F.lit(1)).alias("rows"), F.min("item").alias("a"), F.max("item").alias("b"))
        if most.where((F.col("rows") > 2 * block_terms) & (F.col("a") != F.col("b"))).isEmpty():
            break
        n *= 2
    for block in range(n):
        rows = dealt.where(F.col("block") == block).select("item", "term", "q").toArrow()
        found: dict[int, list] = {}
        for item, term, q in zip(*(rows.column(c).to_pylist() for c in ("item", "term", "q"))):
            found.setdefault(item, []).append((term, q))
        if found:
            yield found


def forward(docs: DataFrame, vocabulary: list[bytes], text="text", doc_id="doc_id") -> DataFrame:
    """Stored rows (doc_id, n, terms, tfs): length and counts of the vocabulary's terms of each document with a term."""

    def count(batches):
        number = {term: i for i, term in enumerate(vocabulary)}.get
        for batch in batches:
            lengths, sizes, ids = [], [], []
            for raw in _texts(batch):
                words = terms(raw)
                known = [i for i in map(number, words) if i is not None]
                lengths.append(len(words))
                sizes.append(len(known))
                ids.append(known)
            at = np.repeat(np.arange(len(ids), dtype=np.int64), sizes)
            flat = np.fromiter(chain.from_iterable(ids), np.int64, len(at))
            pairs, tfs = np.unique(at * len(vocabulary) + flat, return_counts=True) if len(at) else (at, at)
            offsets = np.searchsorted(pairs, np.arange(len(ids) + 1) * len(vocabulary)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (pairs % max(1, len(vocabulary)), tfs)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lengths, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("_text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n bigint, terms array<int>, tfs array<int>"
    return materialize(rows.mapInArrow(count, schema).where("n > 0"), "forward")


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 ln((2 N + 2) / (2 df + 1))) of each term."""
    return np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, length: int) -> np.ndarray:
    m = 25 + (75 * n * n_docs) // max(1, length)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def no_random_access(lists, n_docs: int, k: int, depth=FIRST_DEPTH):
    """Documents that may be among the best k, and their exact scores.

    `lists` holds (weight, documents, impacts) with falling impacts. All places whose score is that of the k-th or higher are returned.
    """
    lower = np.zeros(n_docs, np.int64)
    lists = [x for x in lists if x[0] > 0 and len(x[1])]
    left, start = None, 0
    while True:
        bounds = []
        for weight, docs, impact in lists:
            there, more = docs[start:depth], impact[start:depth]
            if left is not None:
                kept = left[there]
                there, more = there[kept], more[kept]
            # A document occurs once in a list, so no place is written twice here.
            lower[there] += weight * more
            bounds.append(int(weight * impact[depth]) if depth < len(docs) else 0)
        unread = sum(bounds)
        kth = int(np.partition(lower, n_docs - k)[n_docs - k]) if n_docs >= k else 0
        if not unread:
            break
        if kth > unread:
            upper = lower + unread
            for (_, docs, _), bound in zip(lists, bounds):
                if bound:
                    upper[docs[:depth]] -= bound
            left = (upper >= kth) if left is None else left & (upper >= kth)
            if np.array_equal(upper[left], lower[left]):
                break
        start, depth = depth, 2 * depth
    found = np.flatnonzero((lower >= max(kth, 1)) & (True if left is None else left))
    return found, lower[found]


def _best(found, scores, doc_ids, k):
    """The best k: by falling score, equal scores by id, null ids last."""
    order = sorted(range(len(found)), key=lambda i: (-scores[i], doc_ids[found[i]] is None, doc_ids[found[i]] or 0))
    return [(doc_ids[found[i]], int(scores[i])) for i in order[:k]]


def _chunks(batches, docs, postings):
    """Batches joined until they hold that many documents or postings."""
    held, n, size = [], 0, 0
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            held.append(part)
            n, size = n + part.num_rows, size + len(part.column("terms").flatten())
            if n >= docs or size >= postings:
                yield pa.Table.from_batches(held).combine_chunks()
                held, n, size = [], 0, 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def best_by_chunk(stored: DataFrame, items: dict, vocabulary, weight, n_docs, length, k, chunk=(CHUNK_DOCS, CHUNK_POSTINGS), depth=FIRST_DEPTH) -> DataFrame:
    """(item, doc_id, score): the best k of each chunk of documents."""
    number = {term: i for i, term in enumerate(vocabulary)}
    asked = {item: [(number[term], q) for term, q in found] for item, found in items.items()}
    kind = stored.schema["doc_id"].dataType

    def search(batches):
        for table in _chunks(batches, *chunk):
            doc_ids = table.column("doc_id").to_pylist()
            listed, tfs = (table.column(c).combine_chunks() for c in ("terms", "tfs"))
            sizes = np.diff(listed.offsets.to_numpy())
            term, tf = listed.flatten().to_numpy(), tfs.flatten().to_numpy().astype(np.int64)
            doc = np.repeat(np.arange(len(doc_ids), dtype=np.int32), sizes)
            impact = impacts(tf, table.column("n").to_numpy()[doc], n_docs, length)
            order = np.lexsort((-impact, term))
            term, doc, impact = term[order], doc[order], impact[order]
            ends = np.searchsorted(term, np.arange(len(vocabulary) + 1))
            out = []
            for item, wanted in asked.items():
                lists = [(q * int(weight[t]), doc[ends[t] : ends[t + 1]], impact[ends[t] : ends[t + 1]]) for t, q in wanted]
                found, scores = no_random_access(lists, len(doc_ids), k, depth)
                out += [(item, d, s) for d, s in _best(found, scores.tolist(), doc_ids, k)]
            columns = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], table.schema.field("doc_id").type), pa.array(columns[2], pa.int64())], ["item", "doc_id", "score"])

    return stored.mapInArrow(search, f"item bigint, doc_id {kind.simpleString()}, score bigint")


def search(docs: DataFrame, items: DataFrame, k=10, text="text", block_terms=BLOCK_TERMS, chunk=(CHUNK_DOCS, CHUNK_POSTINGS), depth=FIRST_DEPTH) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of `docs` (doc_id, text) that score highest for each of `items` (item_id, text)."""
    counted = item_terms(items, text)
    kinds = f"item bigint, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score bigint"
    best = docs.sparkSession.createDataFrame([], kinds)
    for block in blocks(counted, block_terms):
        vocabulary = sorted({term for found in block.values() for term, _ in found})
        stored = forward(docs, vocabulary, text)
        n_docs, length = stored.agg(F.count(F.lit(1)), F.sum("n")).first()
        df = np.zeros(len(vocabulary), np.int64)
        # One row per term of the block.
        for row in stored.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():
            df[row[0]] = row[1]
        best = best.union(best_by_chunk(stored, block, vocabulary, weights(n_docs, df), n_docs, length or 0, k, chunk, depth))
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    ranked = best.withColumn("rank", place).where(F.col("rank") <= k)
    return ranked.join(counted.select("item", "item_id").distinct(), "item").select("item_id", "rank", "doc_id", "score")
