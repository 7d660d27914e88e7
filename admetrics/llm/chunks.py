"""Cutting text for byte-level BPE where no token can cross, so that short chunks can be encoded once and reused.

The pre-tokenizer lets a token start with one space, and treats a run of white space as one. A single space between two
characters that are not white space therefore always starts a token, whatever stands around it. Text is cut
there; every chunk but the first has a leading space.
"""

from itertools import chain

#: Entries of a worker's cache; chunks of more characters are not kept in it.
CACHE_ENTRIES = 600_000
CACHED_CHARS = 48

#: Characters that are encoded in one call, as long as it is more than one text.
_CALL_CHARS = 2_000_000


#: White space other than the space, for Python or for the pre-tokenizer: fixed values.
_OTHER_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def _loose(text: str) -> bool:
    """Whether a space stands at an end of the text or beside other white space."""
    if "  " in text or text[:1] == " " or text[-1:] == " ":
        return True
    return any(c in text and (" " + c in text or c + " " in text) for c in _OTHER_SPACE)


def chunks(text: str) -> list[str]:
    """The chunks of a text without their leading spaces; joined by single spaces they give the text again."""
    parts = text.split(" ")
    if not _loose(text):
        return parts
    out, start = [], 0
    for i in range(1, len(parts)):
        left, right = parts[i - 1], parts[i]
        if left and right and not left[-1].isspace() and not right[0].isspace():
            out.append(" ".join(parts[start:i]))
            start = i
    return [*out, " ".join(parts[start:])]


class ChunkEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids, one chunk at a time.

    `encode_many(chunks) -> id bytes of each` is called for chunks, with their leading spaces, that are not in the cache. The cache is
    emptied when full, so its memory is bounded.
    """

    def __init__(self, encode_many, entries=CACHE_ENTRIES):
        self._encode_many, self._entries, self._known, self._known_first = encode_many, entries, {}, {}

    def _look_up(self, known, lists, space):
        """The ids of each list of chunks, joined."""
        missing = list(set(chain.from_iterable(lists)).difference(known))
        known.update(zip(missing, self._encode_many([space + c for c in missing])))
        joined = [b"".join(map(known.__getitem__, parts)) for parts in lists]
        for chunk in missing:
            if len(chunk) > CACHED_CHARS:
                del known[chunk]
        return joined

    def __call__(self, texts: list[str]) -> list[bytes]:
        split = [chunks(t) for t in texts]
        first = self._look_up(self._known_first, [parts[:1] for parts in split], "")
        rest = self._look_up(self._known, [parts[1:] for parts in split], " ")
        if len(self._known) + len(self._known_first) > self._entries:
            self._known.clear()
            self._known_first.clear()
        return [a + b for a, b in zip(first, rest)]


def in_calls(texts):
    """Slices of a list of texts (None: empty) of bounded size, each with its first position."""
    start = size = 0
    for i, text in enumerate(texts):
        n = len(text or "")
        if size and size + n > _CALL_CHARS:
            yield start, [t or "" for t in texts[start:i]]
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, [t or "" for t in texts[start:]]
