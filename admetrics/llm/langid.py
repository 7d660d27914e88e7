"""Language identification by unigram pieces, summed over all segmentations.

A model holds, for each language, a probability of every piece of a fixed public vocabulary. The score of a word is the
sum over all ways to cut its bytes into pieces, by the forward algorithm; a text's score is the sum over its words of the
log score. The pieces' probabilities are fitted by expectation-maximisation on counted words: a forward and a backward pass give each
piece's expected count, these are added per language by Spark, and a small share of a uniform distribution is
mixed in, so that no word is impossible.

Words are lower-cased runs of letters, cut every `RUN` letters, each with a leading space as in the vocabulary. Training takes a bounded
sample: per language, about `sample_docs` documents with the smallest hashes of their ids, whole texts. Prediction reads
nothing but the text.

Defined cases: a text that is null or has no letter is `und` with score 0. The score is the posterior of the predicted language
under equal priors; a text of more than `EVIDENCE` bytes of letters is taken as so many bytes of its mean evidence;
ties go to the first language by name. Training rows with a null text or language are left out. With no training rows every text is
`und`. Repeated rows and extra columns change nothing. More than `MAX_LANGUAGES` languages raise an error: labels are a closed set.
"""

import json
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from admetrics.llm.bpe import byte_letters
from admetrics.llm.chunks import in_calls
from admetrics.llm.workers import held
from admetrics.session import materialize

RUN = 16
SAMPLE_DOCS = 2_000
ROUNDS = 4
MAX_LANGUAGES = 256
UNKNOWN = "und"
_UNIFORM = 1e-4
EVIDENCE = 200
_CACHE_WORDS = 200_000
_LETTERS = re.compile(rf"[^\W\d_]{{1,{RUN}}}")
#: Pieces that can occur in a lower-cased word with a leading space.
_USABLE = re.compile(rb" ?[a-z\x80-\xff]*")
#: Each byte's probability is multiplied by this, so that words of up to 4 * RUN + 1 bytes stay inside floating point.
_SCALE = 2.0**15
#: Cells (word, byte, language) of one lattice.
_CELLS = 1 << 21


def words_of(text: str | None) -> list[str]:
    """Lower-cased letter runs of a text, cut every RUN letters."""
    lower = (text or "").lower()
    found = _LETTERS.findall(lower)
    if "".join(found).isalpha() or not found:
        return found
    # The pattern also takes numbers that are no decimal digits, such as fractions.
    return _LETTERS.findall("".join(c if c.isalpha() else " " for c in lower))


class Pieces:
    """A vocabulary's pieces by hash: piece numbers of all substrings of many words at once."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        letters = byte_letters()
        pieces = sorted({bytes(letters[c] for c in token) for token in vocabulary})
        self.pieces = [p for p in pieces if len(p) == 1 or len(p) <= 4 * RUN + 1 and _USABLE.fullmatch(p)]
        self.longest = max(map(len, self.pieces))
        hashed = np.array([self._hash_one(p) for p in self.pieces], np.uint64)
        order = np.argsort(hashed)
        self._keys, self._numbers = hashed[order], order
        if len(np.unique(hashed)) != len(hashed):
            raise ValueError("two pieces share a hash")
        self.sizes = np.array([len(p) for p in self.pieces])
        self._lengths = self.sizes[order]
        self.lengths_used = set(map(len, self.pieces))

    _BASE = np.uint64(0x9E3779B97F4A7C15)

    @classmethod
    def _hash_one(cls, piece):
        value = 0
        for b in piece:
            value = (value + b + 1) * int(cls._BASE) % 2**64
        return value

    def __len__(self):
        return len(self.pieces)

    def spans(self, words: list[bytes]):
        """Pieces inside the words: arrays (word, start, length, piece number), grouped by length."""
        width = max(map(len, words))
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
        size = np.array(list(map(len, words)))
        hashed = np.zeros((len(words), width), np.uint64)
        for length in range(1, min(width, self.longest) + 1):
            hashed = (hashed[:, : width - length + 1] + raw[:, length - 1 :] + np.uint64(1)) * self._BASE
            if length not in self.lengths_used:
                continue
            inside = np.arange(width - length + 1) <= (size - length)[:, None]
            word, start = np.nonzero(inside)
            wanted = hashed[word, start]
            at = np.minimum(np.searchsorted(self._keys, wanted), len(self._keys) - 1)
            hit = (self._keys[at] == wanted) & (self._lengths[at] == length)
            if hit.any():
                yield length, word[hit], start[hit], self._numbers[at[hit]]


def pieces_of(path: str) -> Pieces:
    """The pieces of a file, kept by a worker while it trains."""
    return held(("pieces", path), lambda: Pieces(path))


def _lattice(pieces, words):
    """The spans of all words in order of their end, then length: word, start, end, piece."""
    found = list(pieces.spans(words))
    length = np.concatenate([np.full(len(w), n) for n, w, _, _ in found])
    word, start, piece = (np.concatenate([x[k] for x in found]) for k in (1, 2, 3))
    order = np.lexsort([length, start + length])
    return word[order], start[order], (start + length)[order], piece[order]


def _steps(lattice):
    """Slices of spans with equal end and length: no word occurs twice in one."""
    _, start, end, _ = lattice
    cuts = np.flatnonzero(np.diff(end) | np.diff(end - start)) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(end)]))


def forward(n_words, lattice, scaled):
    """Sums over segmentations up to each byte: array (word, position, language); scaled[piece, language]."""
    word, start, end, piece = lattice
    alpha = np.zeros((n_words, int(end.max()) + 1, scaled.shape[1]))
    alpha[:, 0] = 1
    for s, e in _steps(lattice):
        alpha[word[s:e], end[s]] += alpha[word[s:e], start[s:e]] * scaled[piece[s:e]]
    return alpha


def scaled_weights(pieces: Pieces, weights):
    return weights * _SCALE ** pieces.sizes[:, None].astype(float)


def _batches(words, languages):
    """Positions of words of similar length, few enough for one lattice."""
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    k = 0
    while k < len(order):
        n = max(64, _CELLS // ((4 * RUN + 2) * languages))
        yield order[k : k + n]
        k += n


def word_scores(pieces: Pieces, scaled, words: list[str]) -> np.ndarray:
    """Log score of each word in each language."""
    out = np.empty((len(words), scaled.shape[1]))
    for part in _batches(words, scaled.shape[1]):
        raw = [b" " + words[i].encode() for i in part]
        size = np.array(list(map(len, raw)))
        alpha = forward(len(raw), _lattice(pieces, raw), scaled)
        out[part] = np.log(alpha[np.arange(len(raw)), size]) - (size * np.log(_SCALE))[:, None]
    return out


def _expected(pieces, scaled, words, counts):
    """Expected count of each piece over counted words of one language."""
    out = np.zeros(len(pieces))
    scaled = scaled[:, None]
    for part in _batches(words, 1):
        raw = [b" " + words[i].encode() for i in part]
        count = np.array([counts[i] for i in part], float)
        size = np.array(list(map(len, raw)))
        lattice = word, start, end, piece = _lattice(pieces, raw)
        alpha = forward(len(raw), lattice, scaled)[:, :, 0]
        beta = np.zeros_like(alpha)
        beta[np.arange(len(raw)), size] = 1
        for s, e in reversed(_steps(lattice)):
            beta[word[s:e], start[s:e]] += beta[word[s:e], end[s]] * scaled[piece[s:e], 0]
        total = alpha[np.arange(len(raw)), size]
        share = alpha[word, start] * scaled[piece, 0] * beta[word, end] * count[word] / total[word]
        out += np.bincount(piece, share, len(out))
    return out


def _sampled(docs: DataFrame, sample_docs: int) -> DataFrame:
    """About `sample_docs` rows of each language, by the smallest hashes of doc_id.

    The share is set from the counts per language, so no language is sorted or gathered.
    """
    rows = docs.where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    share = F.lit(1.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, min(1.0, sample_docs / n)).otherwise(share)
    spot = F.pmod(F.xxhash64(F.lit("language sample"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    return rows.where(spot < share)


def train(docs: DataFrame, tokenizer_path: str, sample_docs=SAMPLE_DOCS, rounds=ROUNDS):
    """A model (languages, piece probabilities as a matrix piece x language) from columns doc_id, text and lang."""
    spark = docs.sparkSession

    def count(batches):
        for batch in batches:
            tally = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                for word in words_of(text):
                    tally[lang, word] = tally.get((lang, word), 0) + 1
            if tally:
                langs, words = zip(*tally)
                yield pa.RecordBatch.from_pydict({"lang": langs, "word": words, "n": list(tally.values())})

    sample = _sampled(docs, sample_docs).select("lang", "text")
    counted = sample.mapInArrow(count, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counted = materialize(counted, "language-words")
    languages = sorted(r.lang for r in counted.select("lang").distinct().collect())
    pieces = Pieces(tokenizer_path)
    start = np.array([2.0 ** -(8 + 2 * len(p)) if len(p) > 1 else 2.0**-10 for p in pieces.pieces])
    weights = np.repeat(start[:, None] / start.sum(), len(languages), 1)
    for _ in range(rounds if languages else 0):
        sent = spark.sparkContext.broadcast((languages, weights.astype(np.float32)))

        def expect(batches):
            own, (names, current) = pieces_of(tokenizer_path), sent.value
            scaled, sums = scaled_weights(own, current.astype(float)), {}
            for batch in batches:
                by_lang = {}
                for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n"))):
                    by_lang.setdefault(names.index(lang), []).append((word, n))
                for k, rows in by_lang.items():
                    sums[k] = sums.get(k, 0) + _expected(own, scaled[:, k], *zip(*rows))
            for k, got in sums.items():
                used = np.flatnonzero(got)
                yield pa.RecordBatch.from_pydict(
                    {"language": pa.array(np.full(len(used), k, np.int32)), "piece": pa.array(used.astype(np.int32)), "n": got[used]}
                )

        expected = counted.mapInArrow(expect, "language int, piece int, n double").groupBy("language", "piece").agg(F.sum("n").alias("n"))
        # At most one row for each piece and language.
        table = expected.toArrow()
        language, piece, n = (table.column(c).to_numpy() for c in ("language", "piece", "n"))
        weights = np.zeros_like(weights)
        weights[piece, language] = n
        weights = (1 - _UNIFORM) * weights / weights.sum(0) + _UNIFORM / len(pieces)
    return languages, weights.astype(np.float32)


class Scorer:
    """Predicts texts with a model, keeping the scores of words seen before within a bound."""

    def __init__(self, pieces, languages, weights):
        self._pieces, self._languages = pieces, languages
        self._scaled = scaled_weights(pieces, weights.astype(float))
        self._known, self._scores = {}, np.zeros((0, len(languages)))

    def __call__(self, texts):
        if len(self._known) > _CACHE_WORDS:
            self._known, self._scores = {}, self._scores[:0]
        split = [words_of(t) for t in texts] if self._languages else [[]] * len(texts)
        missing = list(set().union(*split) - self._known.keys())
        if missing:
            self._known.update(zip(missing, range(len(self._scores), len(self._scores) + len(missing))))
            self._scores = np.concatenate([self._scores, word_scores(self._pieces, self._scaled, missing)])
        out = []
        for words in split:
            if not words:
                out.append((UNKNOWN, 0.0))
                continue
            total = self._scores[np.fromiter(map(self._known.__getitem__, words), np.int64, len(words))].sum(0)
            size = len("".join(words).encode())
            best = int(np.argmax(total))
            scaled = (total - total[best]) * min(1.0, EVIDENCE / size)
            out.append((self._languages[best], float(1 / np.exp(scaled).sum())))
        return out


def predict(docs: DataFrame, model, tokenizer_path: str, text="text") -> DataFrame:
    """The input with lang_pred and score."""
    languages, weights = model
    # Pieces x languages, both bounded.
    sent, name = docs.sparkSession.sparkContext.broadcast((languages, weights)), uuid.uuid4().hex
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]

    def label(batches):
        scorer = held(("scorer", name), lambda: Scorer(Pieces(tokenizer_path), *sent.value))
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            for k, call in in_calls(texts):
                lang, score = zip(*scorer(call))
                rows = batch.slice(k, len(lang)).column("_row")
                yield pa.RecordBatch.from_arrays([rows, pa.array(lang), pa.array(score, pa.float64())], ["_row", "lang_pred", "score"])

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"), F.col(f"`{text}`").alias("_text"))
    schema = T.StructType([rows.schema["_row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(label, schema).select("_row.*", "lang_pred", "score")
