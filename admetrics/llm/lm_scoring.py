"""Cross-entropy difference: a target and a background bigram model over all words, and their loss on each document.

Tokens are runs of letters in the case they have, runs of digits, and single other characters that are not white space. The vocabulary is all words
of the documents, an entry for unknown words and one for the start of a document. Both models are counted in one pass over all documents, the background on all of them, the target on the chosen ones, and are
smoothed alike: p(w | v) = (c(v, w) + m p(w)) / (c(v) + m), with p(w) = (c(w) + 1) / (N + vocabulary). A document's loss is the mean of
-ln p over its tokens; its score is target loss minus background loss, so low scores are like the target.

What is gathered grows with the corpus, and nothing but three totals reaches the driver. Words are known by 64-bit hashes, and so are texts; equal texts
share one result. Two forms give the same losses:

- `score_counted` scores the documents that both models are counted on. Texts become slices of two million tokens, stored as the hashes of their distinct words and
  the tokens as places in these. A slice counts its bigrams, words and words before another in one sorted list of 64-bit keys, cut into
  buckets by the keys' first bits, as differences of neighbours. A bucket adds up the counts of all its slices and answers each slice in the order of its
  own keys, so an answer has no keys, and the slice computes its losses from the answers. A key occurs once a slice, however frequent it is, so buckets are even, and
  there are as many as the tokens need. When slices and buckets are so many that few keys meet, a list is down to a key, the row that a plain shuffle would send.
- `train` and `score` keep the counts of all words and of all bigrams as Spark tables, for documents of any origin. Each task gathers the bigrams of a slice with the documents that have them; these
  rows are joined with the losses of the bigrams and added up by document. A bigram that was not counted takes its loss from the counts of its two words.

`train` with a `size` gives a model over the `size - 2` most frequent words only, kept in memory as two matrices.

Defined cases: a null or blank text has no tokens and null losses. A null doc_id is scored, but never target. Repeated
target ids count once, repeated documents each time. Ties in the vocabulary go to the first word in order. With no documents there are no
rows; with no target both models are smoothed to the same, uniform distribution over what was seen, and scores still exist. Extra columns stay.
"""

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from admetrics.llm.chunks import in_calls
from admetrics.session import materialize

MASS = 50.0
OTHER, START = 0, 1
#: Stands for the start of a document among the hashes of words.
_START_KEY = xxhash.xxh64_intdigest("", 3)
_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]|_")
_TALLY = 400_000
#: Tokens of a slice (or one longer document) and, on average, of a bucket of keys.
SLICE_TOKENS = 2_000_000
BUCKET_TOKENS = 4_000_000


def tokens_of(text: str | None) -> list[str]:
    return _TOKEN.findall(text or "")


def vocabulary(docs: DataFrame, size) -> list[str]:
    """The most frequent words of all documents, most frequent first."""

    def count(batches):
        tally = {}

        def batch_of():
            return pa.RecordBatch.from_pydict({"word": list(tally), "n": pa.array(tally.values(), pa.int64())})

        for batch in batches:
            for _, call in in_calls(batch.column("text").to_pylist()):
                for text in call:
                    for word in tokens_of(text):
                        tally[word] = tally.get(word, 0) + 1
                if len(tally) > _TALLY:
                    yield batch_of()
                    tally.clear()
        if tally:
            yield batch_of()

    words = docs.select("text").mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return [r.word for r in words.orderBy(F.desc("n"), "word").limit(size - 2).collect()]


def _ids(words, numbers):
    return np.fromiter((numbers.get(w, OTHER) for w in words), np.int64, len(words))


def bigrams(docs: DataFrame, words: list[str], size) -> DataFrame:
    """Counts of (before * size + word): in all documents and in those whose `target` is true."""
    sent = docs.sparkSession.sparkContext.broadcast(words)

    def count(batches):
        numbers = {w: i + 2 for i, w in enumerate(sent.value)}
        sums = np.zeros((2, size * size), np.int64)
        for batch in batches:
            chosen = batch.column("target").to_pylist()
            for at, call in in_calls(batch.column("text").to_pylist()):
                for text, target in zip(call, chosen[at:]):
                    ids = _ids(tokens_of(text), numbers)
                    pair, n = np.unique(np.concatenate([[START], ids[:-1]]) * size + ids if len(ids) else ids, return_counts=True)
                    sums[0, pair] += n
                    if target:
                        sums[1, pair] += n
        seen = np.flatnonzero(sums[0])
        for k in range(0, len(seen), 100_000):
            pair = seen[k : k + 100_000]
            yield pa.RecordBatch.from_pydict({"pair": pair, "n": sums[0, pair], "n_target": sums[1, pair]})

    counted = docs.select("text", "target").mapInArrow(count, "pair bigint, n bigint, n_target bigint")
    return counted.groupBy("pair").agg(F.sum("n").alias("n"), F.sum("n_target").alias("n_target"))


def losses(pair: np.ndarray, n: np.ndarray, size, mass=MASS) -> np.ndarray:
    """-ln p(word | before) as a matrix before x word, from bigram counts."""
    counts = np.zeros(size * size)
    counts[pair] = n
    counts = counts.reshape(size, size)
    single = (counts.sum(0) + 1) / (counts.sum() + size)
    return -np.log((counts + mass * single) / (counts.sum(1, keepdims=True) + mass)).astype(np.float32)


def _counted_pairs(texts: list[str]):
    """The hashes of a slice's distinct words, then, sorted by bigram and text: places of its two words, text, how often."""
    numbers, parts = {}, []
    for text in texts:
        words = tokens_of(text)
        ids = np.fromiter((numbers.setdefault(w, len(numbers) + 1) for w in words), np.int64, len(words))
        parts.append(np.concatenate([[0], ids]))
    size, many = len(numbers) + 1, len(texts)
    code = np.concatenate([(p[:-1] * size + p[1:]) * many + i for i, p in enumerate(parts)])
    code, times = np.unique(code, return_counts=True)
    pair, text = np.divmod(code, many)
    keys = np.array([_START_KEY, *[xxhash.xxh64_intdigest(w, 3) for w in numbers]], np.uint64).view(np.int64)
    return keys, *np.divmod(pair, size), text, times


@dataclass(frozen=True)
class Counts:
    """All bigrams (before, word, n, n_target), all words (key, as word and as before: n and n_target), and totals."""

    pairs: DataFrame
    words: DataFrame
    tokens: int
    target_tokens: int
    size: int
    mass: float

    def losses(self, pair: tuple, word: tuple, before: tuple):
        """-ln p of the target and of the background, from counts (target, background) of the bigram and its words."""
        out = []
        for c, w, v, total in zip(pair, word, before, (self.target_tokens, self.tokens)):
            single = (F.coalesce(w, F.lit(0)) + 1) / F.lit(float(total + self.size))
            out.append(F.log(F.coalesce(v, F.lit(0)) + self.mass) - F.log(c + self.mass * single))
        return out


def _marked(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """text and whether the document is one of the target."""
    chosen = target_ids.select("doc_id").where("doc_id IS NOT NULL").distinct().withColumn("target", F.lit(True))
    # A merge join at every size of the labels, so that what is shuffled grows in proportion to the documents.
    return docs.select("doc_id", "text").join(chosen.hint("merge"), "doc_id", "left").select("text", F.coalesce("target", F.lit(False)).alias("target"))


def count_all(docs: DataFrame, target_ids: DataFrame, mass=MASS) -> Counts:
    """The counts of all words and bigrams; the target documents are those with a doc_id of `target_ids`."""

    def count(batches):
        for batch in batches:
            chosen = np.array(batch.column("target").to_pylist(), bool)
            for at, call in in_calls(batch.column("text").to_pylist()):
                keys, before, word, text, times = _counted_pairs(call)
                if not len(times):
                    continue
                new = np.flatnonzero(np.concatenate([[True], (before[1:] != before[:-1]) | (word[1:] != word[:-1])]))
                of_target = np.add.reduceat(times * chosen[at : at + len(call)][text], new)
                columns = [keys[before[new]], keys[word[new]], np.add.reduceat(times, new), of_target]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["before", "word", "n", "n_target"])

    rows = _marked(docs, target_ids).mapInArrow(count, "before bigint, word bigint, n bigint, n_target bigint")
    pairs = materialize(rows.groupBy("before", "word").agg(F.sum("n").alias("n"), F.sum("n_target").alias("n_target")), "bigrams")
    sums = [
        pairs.groupBy(F.col(c).alias("key")).agg(F.sum(n).alias("n"), F.sum(t).alias("n_target"), F.sum(bn).alias("n_before"), F.sum(bt).alias("n_before_target"))
        for c, n, t, bn, bt in (("word", F.col("n"), F.col("n_target"), F.lit(0), F.lit(0)), ("before", F.lit(0), F.lit(0), F.col("n"), F.col("n_target")))
    ]
    names = ("n", "n_target", "n_before", "n_before_target")
    words = materialize(sums[0].union(sums[1]).groupBy("key").agg(*[F.sum(c).cast("bigint").alias(c) for c in names]), "words")
    total = words.agg(F.sum("n").alias("n"), F.sum("n_target").alias("n_target"), F.count_if(F.col("n") > 0).alias("words")).first()
    return Counts(pairs, words, total.n or 0, total.n_target or 0, total.words + 2, mass)


def _score_all(docs: DataFrame, model: Counts, text, kept) -> DataFrame:
    def split(batches):
        for batch in batches:
            known = batch.column("text_key").to_numpy()
            for at, call in in_calls(batch.column("text").to_pylist()):
                keys, before, word, place, times = _counted_pairs(call)
                if not len(times):
                    continue
                new = np.flatnonzero(np.concatenate([[True], (before[1:] != before[:-1]) | (word[1:] != word[:-1])]))
                offsets = pa.array(np.append(new, len(times)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[before[new]]),
                        pa.array(keys[word[new]]),
                        pa.ListArray.from_arrays(offsets, pa.array(known[at : at + len(call)][place])),
                        pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
                    ],
                    ["before", "word", "texts", "times"],
                )

    def words_as(side):
        return model.words.select(F.col("key").alias(f"{side}_key"), *[F.col(c).alias(f"{side}_{c}") for c in model.words.columns[1:]]).hint("merge")

    def taken(pair):
        sides = (("word_n_target", "word_n"), ("before_n_before_target", "before_n_before"))
        return model.losses(pair, *[tuple(map(F.col, side)) for side in sides])

    target, background = taken((F.col("n_target"), F.col("n")))
    pairs = model.pairs.join(words_as("word"), F.col("word") == F.col("word_key")).join(words_as("before"), F.col("before") == F.col("before_key"))
    pairs = pairs.select("before", "word", target.alias("target"), background.alias("background"))
    key = F.xxhash64(F.col(f"`{text}`").cast("string"))
    rows = docs.select(key.alias("text_key"), F.col(f"`{text}`").alias("text")).where("text IS NOT NULL")
    rows = rows.mapInArrow(split, "before bigint, word bigint, texts array<bigint>, times array<int>")
    joined = rows.join(pairs.hint("merge"), ["before", "word"], "left")
    joined = joined.select("*", F.explode(F.arrays_zip("texts", "times")).alias("of"))
    unseen = F.col("target").isNull()
    by_text = joined.groupBy(F.col("of.texts").alias("text_key"), F.when(unseen, F.col("before")).alias("v"), F.when(unseen, F.col("word")).alias("w"))
    sums = by_text.agg(F.sum("of.times").alias("k"), *[F.sum(F.col(c) * F.col("of.times")).alias(c) for c in ("target", "background")])
    # Sums of counted bigrams look up nothing; the key of the text spreads them.
    sums = sums.join(words_as("word"), F.coalesce("w", "text_key") == F.col("word_key"), "left").join(words_as("before"), F.coalesce("v", "text_key") == F.col("before_key"), "left")
    fresh = taken((F.lit(0), F.lit(0)))
    means = [F.sum(F.when(F.col("w").isNull(), F.col(c)).otherwise(F.col("k") * f)) for c, f in zip(("target", "background"), fresh)]
    found = sums.groupBy("text_key").agg(F.sum("k").alias("k"), *[m.alias(c) for m, c in zip(means, ("target", "background"))])
    # A text given `copies` times counts as often in the sums, so the means stand, and its tokens are a share of them.
    copies = docs.groupBy(key.alias("text_key")).agg(F.count("*").alias("copies"))
    found = found.join(copies.hint("merge"), "text_key")
    n, target, background = (F.col("k") / F.col("copies")).cast("bigint"), F.col("target") / F.col("k"), F.col("background") / F.col("k")
    found = found.select("text_key", n.alias("n_tokens"), target.alias("target_loss"), background.alias("background_loss"), (target - background).alias("score"))
    return _beside(docs, found, text, key, kept)


class _Numbers(dict):
    """Words numbered from 1 as they are asked for."""

    def __missing__(self, word):
        self[word] = number = len(self) + 1
        return number


def _pack(values: np.ndarray) -> bytes:
    """64-bit numbers by planes of bytes, compressed."""
    return pa.compress(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 8 * n, codec="zstd"), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


_SLICE = "slice bigint, tokens bigint, target_tokens bigint, n_words bigint, words binary, ids binary, texts array<bigint>, lengths array<bigint>, targets array<boolean>"


def _slices(docs: DataFrame, slice_tokens) -> DataFrame:
    """Stored slices of the rows (text_key, text, target); texts without tokens are in none."""

    def row(number, words, ids, texts, lengths, targets):
        ids, lengths = np.concatenate(ids), np.array(lengths, np.int64)
        hashes = np.fromiter((xxhash.xxh64_intdigest(w, 3) for w in words), np.uint64, len(words))
        of_target = int(lengths[np.array(targets, bool)].sum())
        values = [number, len(ids), of_target, len(words), _pack(hashes), _pack(ids), texts, lengths, targets]
        kinds = [pa.int64()] * 4 + [pa.binary()] * 2 + [pa.list_(pa.int64())] * 2 + [pa.list_(pa.bool_())]
        names = [field.split()[0] for field in _SLICE.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

    def cut(batches):
        number = TaskContext.get().partitionId() << 33
        words, parts, size = _Numbers(), ([], [], [], []), 0
        for batch in batches:
            for key, text, target in zip(*[batch.column(c) for c in ("text_key", "text", "target")]):
                found = tokens_of(text.as_py())
                if not found:
                    continue
                ids = np.fromiter(map(words.__getitem__, found), np.int64, len(found))
                for part, value in zip(parts, (ids, key.as_py(), len(ids), target.as_py())):
                    part.append(value)
                size += len(ids)
                if size >= slice_tokens:
                    yield row(number, words, *parts)
                    number, words, parts, size = number + 1, _Numbers(), ([], [], [], []), 0
        if size:
            yield row(number, words, *parts)

    return materialize(docs.mapInArrow(cut, _SLICE), "slices")


def _keyed(r: dict):
    """Of a slice: its sorted keys, the places of (bigrams, words, words before) among them, and each token's (bigram, word before, word)."""
    hashes = np.concatenate([np.array([_START_KEY], np.uint64), _unpack(r["words"], r["n_words"])])
    word = _unpack(r["ids"], r["tokens"]).view(np.int64)
    starts = np.cumsum(r["lengths"]) - r["lengths"]
    before = np.concatenate([[0], word[:-1]])
    before[starts] = 0
    code, pair = np.unique(before * len(hashes) + word, return_inverse=True)
    v, w = np.divmod(code, len(hashes))
    # The last two bits say what a key counts; bigrams mix the hashes of their words.
    mixed = hashes[v] * np.uint64(0x9E3779B97F4A7C15) + hashes[w]
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    kinds = [kind & ~np.uint64(3) | np.uint64(i) for i, kind in enumerate((mixed, hashes, hashes))]
    keys = np.concatenate(kinds)
    order = np.argsort(keys)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return keys[order], order, np.split(place, [len(code), len(code) + len(hashes)]), (pair, before, word), (v, w), starts


def _rows_of(table: pa.Table):
    for batch in table.to_batches():
        for i in range(batch.num_rows):
            yield {c: batch.column(c)[i] for c in batch.schema.names}


def _slice_of(row: dict) -> dict:
    flat = {c: row[c].values.to_numpy(zero_copy_only=False) for c in ("texts", "lengths", "targets")}
    return {c: flat[c] if c in flat else v.as_py() for c, v in row.items()}


def _asked(slices: DataFrame, bits) -> DataFrame:
    """The counts of each slice by bucket of keys."""

    def ask(batches):
        for batch in batches:
            for row in _rows_of(pa.Table.from_batches([batch])):
                r = _slice_of(row)
                keys, order, _, tokens, _, _ = _keyed(r)
                sizes = [int(tokens[0].max()) + 1, r["n_words"] + 1, r["n_words"] + 1]
                chosen = np.repeat(r["targets"], r["lengths"])
                n, of_target = (np.concatenate([np.bincount(t[keep], minlength=k) for t, k in zip((tokens[0], tokens[2], tokens[1]), sizes)])[order] for keep in (slice(None), chosen))
                bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(keys)]])
                for a, b in zip(cuts, cuts[1:]):
                    steps = np.diff(keys[a:b], prepend=np.uint64(0))
                    values = [int(bucket[a]), r["slice"], int(b - a), _pack(steps), _pack(n[a:b]), _pack(of_target[a:b])]
                    kinds = [pa.int64()] * 3 + [pa.binary()] * 3
                    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], ["bucket", "slice", "size", "keys", "n", "n_target"])

    return slices.mapInArrow(ask, "bucket bigint, slice bigint, size bigint, keys binary, n binary, n_target binary")


def _answered(asked: DataFrame) -> DataFrame:
    """For each slice and bucket the counts over all slices, in the order of the slice's keys, and once a bucket the number of its words."""

    def add(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys = np.concatenate([np.cumsum(_unpack(r["keys"], r["size"]), dtype=np.uint64) for r in rows])
        order = np.argsort(keys, kind="stable")
        new = np.concatenate([[True], np.diff(keys[order]) > 0])
        first = np.flatnonzero(new)
        place = np.empty(len(keys), np.int64)
        place[order] = np.cumsum(new) - 1
        totals = [np.add.reduceat(np.concatenate([_unpack(r[c], r["size"]) for r in rows])[order], first) for c in ("n", "n_target")]
        # The start of a document has a key among the words, but is never counted as one.
        words = int(np.count_nonzero(((keys[order[first]] & np.uint64(3)) == 1) & (totals[0] > 0)))
        at = np.concatenate([[0], np.cumsum([r["size"] for r in rows])])
        packed = [[_pack(t[place[a:b]]) for a, b in zip(at, at[1:])] for t in totals]
        names = ("bucket", "slice", "size")
        columns = [pa.array([r[c] for r in rows], pa.int64()) for c in names] + [pa.array(p, pa.binary()) for p in packed]
        return pa.Table.from_arrays([*columns, pa.array([words] + [0] * (len(rows) - 1), pa.int64())], [*names, "n", "n_target", "words"])

    found = asked.groupBy("bucket").applyInArrow(add, "bucket bigint, slice bigint, size bigint, n binary, n_target binary, words bigint")
    return materialize(found, "answers")


def score_counted(docs: DataFrame, target_ids: DataFrame, mass=MASS, text="text", slice_tokens=SLICE_TOKENS, bucket_tokens=BUCKET_TOKENS) -> DataFrame:
    """The input with n_tokens, target_loss, background_loss and score, from models counted on the input itself.

    The same values as `score(docs, train(docs, target_ids))`. The column `doc_id` says which documents are the target.
    """
    names = ("n_tokens", "target_loss", "background_loss", "score")
    kept = [c for c in docs.columns if c not in names]
    key = F.xxhash64(F.col(f"`{text}`").cast("string"))
    marked = _marked(docs.select("doc_id", F.col(f"`{text}`").alias("text")).where("text IS NOT NULL"), target_ids)
    slices = _slices(marked.select(F.xxhash64("text").alias("text_key"), "text", "target"), slice_tokens)
    total = slices.agg(F.sum("tokens").alias("n"), F.sum("target_tokens").alias("n_target")).first()
    bits = max(4, int(np.ceil(np.log2(max(1, (total.n or 0) / bucket_tokens)))))
    answers = _answered(_asked(slices, bits))
    size = (answers.agg(F.sum("words").alias("words")).first().words or 0) + 2
    sums = (total.n_target or 0, total.n or 0)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        r = _slice_of(next(_rows_of(left)))
        _, _, (pairs, words, befores), tokens, (v, w), starts = _keyed(r)
        rows = sorted(right.select(["bucket", "size", "n", "n_target"]).to_pylist(), key=lambda x: x["bucket"])
        means = []
        for column, tokens_of_model in zip(("n_target", "n"), sums):
            counts = np.concatenate([_unpack(x[column], x["size"]) for x in rows]).astype(np.float64)
            single = (counts[words] + 1) / (tokens_of_model + size)
            loss = np.log(counts[befores][v] + mass) - np.log(counts[pairs] + mass * single[w])
            means.append(np.add.reduceat(loss[tokens[0]], starts) / r["lengths"])
        columns = [pa.array(r["texts"], pa.int64()), pa.array(r["lengths"], pa.int64()), *[pa.array(m) for m in means]]
        return pa.Table.from_arrays(columns, ["text_key", "n_tokens", "target_loss", "background_loss"])

    found = slices.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(finish, "text_key bigint, n_tokens bigint, target_loss double, background_loss double")
    found = found.groupBy("text_key").agg(F.min(F.struct("n_tokens", "target_loss", "background_loss")).alias("found")).select("text_key", "found.*")
    return _beside(docs, found.withColumn("score", F.col("target_loss") - F.col("background_loss")), text, key, kept)


def _beside(docs: DataFrame, found: DataFrame, text, key, kept) -> DataFrame:
    """The rows with what was found for their texts; a text without tokens has n_tokens 0 and nulls."""
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"), F.when(F.col(f"`{text}`").isNotNull(), key).alias("text_key"))
    scored = given.join(found.hint("merge"), "text_key", "left").withColumn("n_tokens", F.coalesce("n_tokens", F.lit(0).cast("bigint")))
    return scored.select("_row.*", "n_tokens", "target_loss", "background_loss", "score")


def train(docs: DataFrame, target_ids: DataFrame, size=None, mass=MASS):
    """`Counts` of all words, or with a `size` (vocabulary, target losses, background losses) of the most frequent ones."""
    if size is None:
        return count_all(docs, target_ids, mass)
    words = vocabulary(docs, size)
    table = materialize(bigrams(_marked(docs, target_ids), words, size), "bigrams").toArrow()
    pair, n, n_target = (table.column(c).to_numpy() for c in ("pair", "n", "n_target"))
    return words, losses(pair, n_target, size, mass), losses(pair, n, size, mass)


def score(docs: DataFrame, model, text="text") -> DataFrame:
    """The input with n_tokens, target_loss, background_loss and score."""
    names = ("n_tokens", "target_loss", "background_loss", "score")
    kept = [c for c in docs.columns if c not in names]
    if isinstance(model, Counts):
        return _score_all(docs, model, text, kept)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches):
        words, *models = sent.value
        numbers, size = {w: i + 2 for i, w in enumerate(words)}, len(models[0])
        flat = [m.reshape(-1) for m in models]
        for batch in batches:
            for at, call in in_calls(batch.column("_text").to_pylist()):
                out = []
                for body in call:
                    ids = _ids(tokens_of(body), numbers)
                    if not len(ids):
                        out.append((0, None, None, None))
                        continue
                    pair = np.concatenate([[START], ids[:-1]]) * size + ids
                    target, background = (float(m[pair].mean(dtype=np.float64)) for m in flat)
                    out.append((len(ids), target, background, target - background))
                n, *values = zip(*out)
                rows = batch.slice(at, len(call)).column("_row")
                columns = [rows, pa.array(n, pa.int64()), *[pa.array(v, pa.float64()) for v in values]]
                yield pa.RecordBatch.from_arrays(columns, ["_row", *names])

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"), F.col(f"`{text}`").alias("_text"))
    kinds = [T.LongType(), *[T.DoubleType()] * 3]
    schema = T.StructType([rows.schema["_row"], *[T.StructField(c, k) for c, k in zip(names, kinds)]])
    return rows.mapInArrow(judge, schema).select("_row.*", *names)
