"""Split texts into the pieces that byte-level BPE merges separately, for whole Arrow batches at once.

The pattern is the one published with the vocabularies (`public_tokenizers.PATTERN`). Its pieces follow from the class of each
character alone (letter, number, white space, other), so numpy finds all borders of a batch in a few passes. The classes come
from the regular-expression engine of the tokenizer library itself (`tiktoken_classes`, `tokenizers_classes`), since Unicode
versions differ between libraries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
_CLASSES = ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s"))
#: Texts of about so many characters are split in one pass.
SLICE_CHARS = 2_000_000


def _characters() -> str:
    return "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))


def _table(members: Iterator[tuple[int, str]]) -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for kind, found in members:
        table[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    return table


def tiktoken_classes() -> np.ndarray:
    """Class of every code point as tiktoken's engine sees it: it keeps only what a pattern matches."""
    import tiktoken

    every = _characters()
    single = {bytes([b]): b for b in range(256)}

    def members() -> Iterator[tuple[int, str]]:
        for kind, pattern in _CLASSES:
            engine = tiktoken.Encoding(f"class{kind}", pat_str=pattern, mergeable_ranks=single, special_tokens={})
            yield kind, bytes(engine.encode_ordinary(every)).decode()

    return _table(members())


def tokenizers_classes() -> np.ndarray:
    """Class of every code point as the tokenizers library's engine sees it."""
    from tokenizers import Regex, pre_tokenizers

    every = _characters()

    def members() -> Iterator[tuple[int, str]]:
        for kind, pattern in _CLASSES:
            split = pre_tokenizers.Split(Regex(pattern), behavior="removed", invert=True)
            yield kind, "".join(piece for piece, _ in split.pre_tokenize_str(every))

    return _table(members())


def slices(texts: list[str], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about `limit` characters; a longer text is a range of its own."""
    start = total = 0
    for i, text in enumerate(texts):
        if i > start and total + len(text) > limit:
            yield start, i
            start, total = i, 0
        total += len(text)
    if start < len(texts):
        yield start, len(texts)


def listed(values: pa.Array) -> list:
    """The values of an array without nulls; for many short texts faster than to_pylist."""
    return values.to_numpy(zero_copy_only=False).tolist()


def pieces(texts: list[str], classes: np.ndarray) -> tuple[pa.StringArray, np.ndarray]:
    """All pieces of the texts in order, and the number of pieces of each text. An empty text has none."""
    whole = "".join(texts)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    n = len(whole)
    if n == 0:
        return pa.array([], pa.string()), np.zeros(len(texts), np.int64)
    code = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    kind = classes[code]
    ends = np.cumsum(lengths)
    first = np.zeros(n + 1, bool)  # texts begin here; n closes the last
    first[ends - lengths] = True
    first[n] = True
    start = first[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    # A run of white space that text follows gives its last character away: a blank joins the text, others stand alone.
    space = kind == SPACE
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~first[1:n]) if n > 1 else np.zeros(0, np.int64)
    start[last] = True
    start[last[code[last] == 0x20] + 1] = False
    # Contractions: an apostrophe that begins a piece, with the letters that the pattern names.
    quote = np.flatnonzero((code == 0x27) & start)
    if len(quote):
        ahead = [np.where(quote + k < n, code[np.minimum(quote + k, n - 1)], 0) for k in (1, 2)]
        inside = [(quote + k < n) & ~first[np.minimum(quote + k, n)] for k in (1, 2)]
        one = inside[0] & np.isin(ahead[0], [ord(c) for c in "stmd"])
        two = inside[0] & inside[1] & np.any([(ahead[0] == ord(a)) & (ahead[1] == ord(b)) for a, b in ("re", "ve", "ll")], axis=0)
        for taken, width in ((one, 1), (two, 2)):
            at = quote[taken]
            start[at + 1] = False
            after = at + 1 + width
            start[after[after < n]] = True
    begin = np.flatnonzero(start)
    width = np.ones(n, np.int64) + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
    offset = np.zeros(n + 1, np.int64)
    np.cumsum(width, out=offset[1:])
    data = whole.encode()
    bounds = np.append(offset[begin], offset[n])
    if bounds[-1] < 2**31:
        array = pa.StringArray.from_buffers(len(begin), pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data))
    else:
        array = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(bounds), pa.py_buffer(data))
    counts = np.searchsorted(begin, ends) - np.searchsorted(begin, ends - lengths)
    return array, counts
