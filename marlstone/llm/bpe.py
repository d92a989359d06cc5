"""BPE encoding and decoding of whole texts, with tree concatenation for long unsplit text.

A run is a piece of text without a place where the tokenizer's own splitting makes both sides independent (beside
white space). Each run is a binary tree: it is halved until a part has LEAF characters or fewer, all leaves are
encoded on their own, in parallel batches, and the two halves of each node are joined: a window around the
join is encoded anew, and grows until, on both sides, it agrees with the halves' own tokens for a run of AGREE tokens
at the same places. Beyond that, every two neighbouring tokens stand next to each other in an exact encoding,
which makes the whole exact. Most runs are words, trees of one leaf.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a leaf at most.
LEAF = 1024
#: Threads that encode the leaves of one tree; the tokenizer releases the interpreter's lock meanwhile.
THREADS = 2
#: First window on each side of a join, in characters; it doubles.
WINDOW = 64
AGREE = 4

Token = tuple[int, int, int]


def load(path: str):
    """The tokenizer without truncation and padding; one thread for each task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def _tokens(encoding, at: int) -> list[Token]:
    return [(i, s + at, e + at) for i, (s, e) in zip(encoding.ids, encoding.offsets, strict=True)]


def _clean(x: list[Token], i: int) -> bool:
    """Token i shares no character with its neighbours."""
    return (i == 0 or x[i - 1][2] <= x[i][1]) and (i + 1 == len(x) or x[i][2] <= x[i + 1][1]) and x[i][1] < x[i][2]


def _meet(old: list[Token], new: list[Token], last: bool) -> tuple[int, int] | None:
    """Positions in old and new of a token inside a run of AGREE equal ones, neighbours of a clean one."""
    where = {t: i for i, t in enumerate(old) if _clean(old, i)}
    order = range(len(new)) if last else range(len(new) - 1, -1, -1)
    half = AGREE // 2
    for j in order:
        i = where.get(new[j])
        if i is None or not _clean(new, j) or i < half or j < half:
            continue
        if i + half < len(old) and j + half < len(new) and old[i - half : i + half + 1] == new[j - half : j + half + 1]:
            return i, j
    return None


def _join(tok, text: str, left: list[Token], right: list[Token], at: int, low: int, high: int) -> list[Token]:
    """Tokens of text[low:high], from those of text[low:at] and text[at:high]."""
    reach = WINDOW
    while True:
        a, b = max(low, at - reach), min(high, at + reach)
        new = _tokens(tok.encode(text[a:b], add_special_tokens=False), a)
        # the window's outer ends are cut arbitrarily: only an agreement inside counts
        l = (None if a == low else _meet([t for t in left if t[1] >= a], new, True)) if left else None
        r = (None if b == high else _meet([t for t in right if t[2] <= b], new, False)) if right else None
        if (a == low or l) and (b == high or r):
            start, stop, head, tail = 0, len(new), [], []
            if a != low:
                skipped = sum(t[1] < a for t in left)
                head, start = left[: skipped + l[0] + 1], l[1] + 1
            if b != high:
                tail, stop = right[r[0] :], r[1]
            if start <= stop:
                return head + new[start:stop] + tail
        if a == low and b == high:
            return new
        reach *= 2


def _halves(a: int, b: int, leaf: int) -> list[tuple[int, int]]:
    """The leaves of text[a:b]: halved until they fit."""
    if b - a <= leaf:
        return [(a, b)]
    m = (a + b) // 2
    return _halves(a, m, leaf) + _halves(m, b, leaf)


def encode_long(tok, text: str, leaf: int = LEAF) -> list[int]:
    """Ids of a run: leaves in parallel batches, then the joins of a binary tree."""
    leaves = _halves(0, len(text), leaf)
    shares = [leaves[i::THREADS] for i in range(THREADS)]
    with ThreadPoolExecutor(THREADS) as pool:
        done = pool.map(lambda share: tok.encode_batch([text[a:b] for a, b in share], add_special_tokens=False) if share else [], shares)
    tokens = {part: _tokens(e, part[0]) for share, encodings in zip(shares, done, strict=True) for part, e in zip(share, encodings, strict=True)}

    def node(a: int, b: int) -> list[Token]:
        if (a, b) in tokens:
            return tokens.pop((a, b))
        m = (a + b) // 2
        return _join(tok, text, node(a, m), node(m, b), m, a, b)

    return [t[0] for t in node(0, len(text))]


class Coder:
    """Ids of whole texts as arrays of unsigned 32-bit integers."""

    def __init__(self, path: str, leaf: int = LEAF) -> None:
        self.tok, self.leaf = load(path), leaf

    def split(self, text: str) -> list[str]:
        """Pieces that are encoded independently of each other."""
        raise NotImplementedError

    def is_long(self, text: str) -> bool:
        """The text may have a piece of over leaf characters."""
        raise NotImplementedError

    def plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        long = [self.is_long(t) for t in texts]
        plain = iter(self.plain([t for t, x in zip(texts, long, strict=True) if not x]))
        return [np.array(self.in_pieces(t) if x else next(plain), "<u4") for t, x in zip(texts, long, strict=True)]

    def in_pieces(self, text: str) -> list[int]:
        pieces = self.split(text)
        short = iter(self.plain([p for p in pieces if len(p) <= self.leaf]))
        return [i for p in pieces for i in (next(short) if len(p) <= self.leaf else encode_long(self.tok, p, self.leaf))]


_ODD = re.compile("[\x1c-\x1f]")
_BLANKS = re.compile("[ \t\r\n]+")


#: Fixed value: how the word tokenizer splits a normalised text, once for ASCII and once for all of Unicode.
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
_ASCII_WORD = re.compile(_CONTRACTIONS + r"|[a-z]+|[0-9]|[^\x09-\x0d\x20a-z0-9]+")
_WORD = regex.compile(_CONTRACTIONS + r"|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: Fixed value: the mark of a word's end in the vocabulary.
_END = "</w>"


class WordCoder(Coder):
    """For tokenizers that drop white space and end words with a mark: runs are what is between white space.

    Their ids are the ranks of their merges, so a faster library gives the same ids from the same file. There the end
    of a word is a newline, which no word holds: a last letter and the newline are the first merge of all.
    """

    def __init__(self, path: str, leaf: int = LEAF) -> None:
        super().__init__(path, leaf)
        import tiktoken

        self.tokens = [(self.tok.id_to_token(i) or "").encode() for i in range(self.tok.get_vocab_size())]
        byte_of = _byte_of()
        special = {t.content for t in self.tok.get_added_tokens_decoder().values()}
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        vocabulary = {t: i for t, i in self.tok.get_vocab(with_added_tokens=False).items() if t not in special}
        _check_order(self.tok, vocabulary, path)
        ranks = {}
        for t, i in vocabulary.items():
            ends = t.endswith(_END) and t != _END
            ranks[bytes(byte_of[c] for c in (t[: -len(_END)] if ends else t)) + b"\n" * ends] = i
        self.fast = tiktoken.Encoding("own", pat_str=r"[^\n]+\n", mergeable_ranks=ranks, special_tokens={})

    def words(self, text: str) -> list[str]:
        """The tokenizer's own words of a text: normalised, then split."""
        if text.isascii():
            return _ASCII_WORD.findall(text.lower())
        # each character is lower-cased by itself; this is the only one that Python treats by its neighbours
        return _WORD.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def plain(self, texts: list[str]) -> list[list[int]]:
        out = []
        for t in texts:
            if self.special.search(t):
                out.append(self.tok.encode(t, add_special_tokens=False).ids)
            else:
                ws = self.words(t)
                out.append(self.fast.encode_ordinary("\n".join(ws) + "\n") if ws else [])
        return out

    def split(self, text: str) -> list[str]:
        # str.split() knows four separators that the tokenizer's pattern does not count as white space
        return text.split() if not _ODD.search(text) else [p for p in _BLANKS.split(text) if p]

    def is_long(self, text: str) -> bool:
        return len(text) > self.leaf and max(map(len, self.split(text)), default=0) > self.leaf

    def encode_decode(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """For each text its ids, little-endian, and the decoded text in UTF-8.

        The tokenizer has no decoder of its own, which means tokens joined by a space, special ones too.
        """
        token = self.tokens.__getitem__
        for ids in self.encode(texts):
            yield ids.tobytes(), b" ".join(map(token, ids.tolist()))


_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
#: Fixed value: how byte-level tokenizers of this kind split a text.
_BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as they are, and the others, in order, from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def _check_order(tok, vocabulary: dict[str, int], path: str) -> None:
    """An error unless the ids of merged tokens follow the order of the merges, so that they serve as ranks."""
    merges = json.loads(tok.to_str())["model"]["merges"]
    order = [vocabulary["".join(m) if isinstance(m, list) else m.replace(" ", "", 1)] for m in merges]
    if any(a >= b for a, b in zip(order, order[1:])):
        raise ValueError(f"{path}: ids do not follow the order of the merges")


class ByteCoder(Coder):
    """For byte-level tokenizers, where a word takes the space before it.

    Their ids are the ranks of their merges, so a faster library gives the same ids from the same file.
    """

    def __init__(self, path: str, leaf: int = LEAF) -> None:
        super().__init__(path, leaf)
        import tiktoken

        byte_of = _byte_of()
        special = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items()}
        vocabulary = self.tok.get_vocab(with_added_tokens=False)
        _check_order(self.tok, vocabulary, path)
        ranks = {bytes(byte_of[c] for c in t): i for t, i in vocabulary.items() if t not in special}
        self.fast = tiktoken.Encoding("own", pat_str=_BYTE_LEVEL, mergeable_ranks=ranks, special_tokens=special)

    def plain(self, texts: list[str]) -> list[list[int]]:
        return [self.fast.encode(t, allowed_special="all") for t in texts]

    def split(self, text: str) -> list[str]:
        """Pieces that make up the text: a cut stands before each single space between other characters."""
        first, *rest = _BETWEEN.split(text)
        return [first, *(" " + w for w in rest)]

    def is_long(self, text: str) -> bool:
        return len(text) > self.leaf and (" " * self.leaf in text or max(map(len, text.split(" "))) > self.leaf)


_coders: dict[tuple, Coder] = {}


def coder(kind: type[Coder], path: str) -> Coder:
    """This worker's coder, kept between tasks."""
    if (kind, path) not in _coders:
        _coders[kind, path] = kind(path)
    return _coders[kind, path]


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) and, if asked for, ids: one row for each input row.

    The tokenizer must drop white space and have no decoder of its own. A run without white space of any length is
    encoded as a tree (see above). Null text counts as empty: no ids, empty
    decoded text. Repeated rows and null ids pass through. An empty table gives no rows. Other columns are ignored.
    """
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())] + [("ids", pa.list_(pa.int64()))] * ids
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(WordCoder, path)
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                part = batch.slice(i, 200)
                done = [(len(x) // 4, hashlib.sha256(x).hexdigest(), hashlib.sha256(d).hexdigest(), x) for x, d in c.encode_decode([t or "" for t in part.column(1).to_pylist()])]
                cols = [part.column(0), *(pa.array([d[k] for d in done], fields[k + 1][1]) for k in range(3))]
                if ids:
                    cols.append(pa.array([memoryview(d[3]).cast("I").tolist() for d in done], fields[4][1]))
                yield pa.RecordBatch.from_arrays(cols, schema=schema)

    out = docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<bigint>" * ids)
    return out.withColumnRenamed("doc_id", id_col)
