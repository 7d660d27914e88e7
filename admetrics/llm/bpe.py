"""Byte-level BPE: encoding by a segment tree over the ranks of adjacent pairs, decoding by a byte table.

The leaves of the tree are the pairs of neighbouring symbols, each with (rank, position), absent pairs with the largest value. The
root is the smallest, that is the leftmost pair of lowest rank. It is merged, the leaves beside it and its own are
updated along their paths to the root, and this goes on until no mergeable pair is left. Short chunks are merged many at a time
with one numpy tree per chunk, level by level; long ones one by one with the same tree in a list.

Vocabulary and merges are read from a tokenizer file whose path is a parameter. The special token's text inside a document is
that token, as the library has it. A null text is empty: no ids. Repeated rows give repeated results, an empty table an empty one.
Other columns are carried along unless they bear the names of result columns. Texts are encoded whole.
"""

import hashlib
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from admetrics.llm.chunks import ChunkEncoder, in_calls
from admetrics.llm.workers import held

#: Splits text before merging: a fixed value of this family of tokenizers.
PATTERN = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
_NONE = np.int64(np.iinfo(np.int64).max)
_SHORT = 64
_AT_ONCE = 1 << 19


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Ids, bytes and pair ranks of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        letters, model = byte_letters(), data["model"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        size = 1 + max([*model["vocab"].values(), *self.special.values()])
        self.bytes = [b""] * size
        for token, i in model["vocab"].items():
            self.bytes[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.decimal = [str(i).encode() for i in range(size)]
        self.byte_ids = np.empty(256, np.int64)
        for letter, b in letters.items():
            self.byte_ids[b] = model["vocab"][letter]
        self.ranks, pairs = {}, []
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b, made = model["vocab"][left], model["vocab"][right], model["vocab"][left + right]
            self.ranks.setdefault((a, b), (rank, made))
            pairs.append((a * size + b, rank, made))
        self.size = size
        table = np.array(pairs, np.int64)
        _, first = np.unique(table[:, 0], return_index=True)
        self.pair_keys, self.pair_ranks, self.pair_made = table[first].T.copy()
        self.special_pattern = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    def look_up(self, left: np.ndarray, right: np.ndarray):
        """Rank and merged id of each pair; rank -1 where there is none."""
        wanted = left * self.size + right
        at = np.minimum(np.searchsorted(self.pair_keys, wanted), len(self.pair_keys) - 1)
        hit = (self.pair_keys[at] == wanted) & (left >= 0) & (right >= 0)
        return np.where(hit, self.pair_ranks[at], -1), self.pair_made[at]


def merge_one(vocabulary: Vocabulary, symbols: list[int]) -> list[int]:
    """BPE of one sequence with a segment tree in a list."""
    n = len(symbols)
    if n < 2:
        return symbols
    ids, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
    ranks, width = vocabulary.ranks, 1 << (n - 2).bit_length()
    none = (1 << 62, 0)
    leaf = lambda i: (ranks[p][0], i) if after[i] < n and (p := (ids[i], ids[after[i]])) in ranks else none
    tree = [none] * (2 * width)
    tree[width : width + n - 1] = map(leaf, range(n - 1))
    for k in range(width - 1, 0, -1):
        tree[k] = min(tree[2 * k], tree[2 * k + 1])

    def put(i, value):
        k = width + i
        tree[k] = value
        while k > 1:
            k //= 2
            best = min(tree[2 * k], tree[2 * k + 1])
            if tree[k] == best:
                break
            tree[k] = best

    while tree[1] is not none and tree[1] < none:
        i = tree[1][1]
        gone = after[i]
        ids[i] = ranks[ids[i], ids[gone]][1]
        after[i] = after[gone]
        if after[i] < n:
            before[after[i]] = i
        if gone < n - 1:
            put(gone, none)
        put(i, leaf(i)) if i < n - 1 else None
        if before[i] >= 0:
            put(before[i], leaf(before[i]))
    out, i = [], 0
    while i < n:
        out.append(ids[i])
        i = after[i]
    return out


def merge_many(vocabulary: Vocabulary, ids: np.ndarray, n: np.ndarray) -> np.ndarray:
    """BPE of each row of `ids` (its first n entries), one tree per row; what is merged away becomes -1.

    The width of `ids` is a power of two.
    """
    rows, width = ids.shape
    place = np.arange(width)
    inside = place < n[:, None]
    ids = np.where(inside, ids, -1)
    after = np.broadcast_to(place + 1, ids.shape).copy()
    before = np.broadcast_to(place - 1, ids.shape).copy()
    tree = np.full((rows, 2 * width), _NONE)
    rank, made = vocabulary.look_up(ids[:, :-1], ids[:, 1:])
    tree[:, width : 2 * width - 1] = np.where(rank >= 0, rank * width + place[:-1], _NONE)
    result = np.zeros((rows, width), np.int64)
    result[:, :-1] = made
    level = width
    while level > 1:
        tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
        level //= 2

    def put(r, i, value):
        k = width + i
        tree[r, k] = value
        while k[0] > 1:
            k = k // 2
            tree[r, k] = np.minimum(tree[r, 2 * k], tree[r, 2 * k + 1])

    def renew(r, i):
        """Sets the leaf of the pair that starts at i."""
        j = after[r, i]
        right = np.where(j < width, ids[r, np.minimum(j, width - 1)], -1)
        rank, made = vocabulary.look_up(ids[r, i], right)
        result[r, i] = made
        put(r, i, np.where(rank >= 0, rank * width + i, _NONE))

    live = np.flatnonzero(tree[:, 1] != _NONE)
    while len(live):
        i = tree[live, 1] % width
        gone = after[live, i]
        ids[live, i] = result[live, i]
        ids[live, gone] = -1
        follow = after[live, gone]
        after[live, i] = follow
        linked = follow < width
        before[live[linked], follow[linked]] = i[linked]
        put(live, gone, np.full(len(live), _NONE))
        renew(live, i)
        ahead = before[live, i]
        has = ahead >= 0
        if has.any():
            renew(live[has], ahead[has])
        live = live[tree[live, 1] != _NONE]
    return ids


class Encoder:
    """Encodes chunks of text by splitting and merging."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def _words(self, chunk: str):
        """The pre-tokens of a chunk as bytes; a special token as its id."""
        special = self.vocabulary.special_pattern
        at = 0
        for m in special.finditer(chunk) if special else ():
            yield from (w.encode() for w in PATTERN.findall(chunk[at : m.start()]))
            yield self.vocabulary.special[m[0]]
            at = m.end()
        yield from (w.encode() for w in PATTERN.findall(chunk[at:] if at else chunk))

    def words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """The id bytes of each distinct word."""
        out, by_width = {}, {}
        for word in words:
            if len(word) > _SHORT:
                out[word] = np.array(merge_one(self.vocabulary, self.vocabulary.byte_ids[list(word)].tolist()), "<u4").tobytes()
            else:
                by_width.setdefault(max(4, 1 << (len(word) - 1).bit_length()), []).append(word)
        for width, same in by_width.items():
            for k in range(0, len(same), _AT_ONCE // width):
                part = same[k : k + _AT_ONCE // width]
                raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in part), np.uint8).reshape(-1, width)
                merged = merge_many(self.vocabulary, self.vocabulary.byte_ids[raw], np.array(list(map(len, part))))
                there = merged >= 0
                flat, ends = merged[there].astype("<u4").tobytes(), 4 * np.cumsum(there.sum(1))
                start = 0
                for word, end in zip(part, ends.tolist()):
                    out[word] = flat[start:end]
                    start = end
        return out

    def __call__(self, parts: list[str]) -> list[bytes]:
        split = [list(self._words(p)) for p in parts]
        known = self.words(list({w for ws in split for w in ws if isinstance(w, bytes)}))
        return [b"".join([known[w] if isinstance(w, bytes) else w.to_bytes(4, "little") for w in ws]) for ws in split]


def loaded(path: str):
    """Vocabulary and encoder of a file, kept by a worker while it serves this operator."""

    def make():
        vocabulary = Vocabulary(path)
        return vocabulary, ChunkEncoder(Encoder(vocabulary))

    return held(("encoder", path), make)


def decode(vocabulary: Vocabulary, ids) -> str:
    """The text of ids, special tokens kept; bytes that are not UTF-8 become the replacement character."""
    return b"".join(map(vocabulary.bytes.__getitem__, ids)).decode("utf-8", "replace")


#: What `encode_texts` can add to a row.
FIELDS = {
    "ids": T.ArrayType(T.IntegerType()),
    "n_tokens": T.LongType(),
    "ids_sha256": T.StringType(),
    "decoded": T.StringType(),
    "decoded_sha256": T.StringType(),
}


def encode_texts(docs: DataFrame, tokenizer_path: str, text="text", fields=("ids", "n_tokens")) -> DataFrame:
    """The input with the asked fields; decoded ones are decoded from the ids."""
    kept = [c for c in docs.columns if c not in fields]
    kinds = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}

    def encode(batches):
        vocabulary, encoder = loaded(tokenizer_path)
        for batch in batches:
            for at, call in in_calls(batch.column("_text").to_pylist()):
                out = {f: [] for f in fields}
                for raw in encoder(call):
                    ids = np.frombuffer(raw, "<u4").tolist()
                    made = {"ids": ids, "n_tokens": len(ids)}
                    if "ids_sha256" in out:
                        made["ids_sha256"] = hashlib.sha256(b",".join(map(vocabulary.decimal.__getitem__, ids))).hexdigest()
                    if "decoded" in out or "decoded_sha256" in out:
                        made["decoded"] = decode(vocabulary, ids)
                        made["decoded_sha256"] = hashlib.sha256(made["decoded"].encode()).hexdigest()
                    for f in fields:
                        out[f].append(made[f])
                rows = batch.slice(at, len(call)).column("_row")
                yield pa.RecordBatch.from_arrays(
                    [rows, *[pa.array(out[f], kinds.get(f, pa.string())) for f in fields]], ["_row", *fields]
                )

    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"), F.col(f"`{text}`").alias("_text"))
    schema = T.StructType([row.schema["_row"], *[T.StructField(f, FIELDS[f]) for f in fields]])
    return row.mapInArrow(encode, schema).select("_row.*", *fields)
