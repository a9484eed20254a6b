"""Alignment of two tokenizers' tokens, by a monoid of fragments.

Both tokenizers cut the same bytes. Where a token of each ends at one byte, a
group of tokens ends; every document is a sequence of such groups.

A stretch of a document gives a fragment: tokens before its first common end
(open, since tokens further left may belong to them), closed groups, and tokens
behind its last common end (open to the right). Fragments of neighbouring
stretches compose: what is open between them is cut at the common ends it turns
out to hold. The composition is associative, so a document's fragments can be
put together in any bracketing.

Short documents are fragments of their own and need no composition. A long one
is cut into ranges of bytes, for either tokenizer at the next place where that
tokenizer surely ends a token, which are different places; ranges are tokenized
in separate tasks and composed in a tree of groupings.

Documents are kept in blocks. A block lists its distinct pairs of linked ids
with the number of documents that hold them; sums of these are the counts in the
corpus, and come back to the block by pair.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache, reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from hourloom.llm.common import pack, pack_sorted, unpack, unpack_sorted
from hourloom.session import materialise

#: Documents of more bytes are cut into ranges of about this size.
CHUNK_BYTES = 1 << 16
#: Text of one block; a longer document is a block of its own.
BLOCK_BYTES = 2 << 20
#: Fragments that one task composes.
FAN = 16
#: Different words that a task remembers the tokens of.
REMEMBERED = 200_000
#: Links laid out at once; a larger group is counted by its distinct ids.
LINKS = 1 << 19

#: Ids are below 2^20, and a block holds fewer than 2^23 documents.
ID_BITS, DOC_BITS = 20, 23

# A single space between two characters that are not white space: both tokenizers end a token before it.
BETWEEN = re.compile(r"(?<=\S) (?=\S)")
DOUBLE = re.compile(r"\s | \s")
# A letter before something that is neither letter, mark nor digit: the byte-level tokenizer splits there.
AFTER_LETTER = re.compile(r"(?<=[A-Za-z])(?=[ !-/:-@\[-`{-~\n])")

FRAGMENT = pa.schema(
    [("row", pa.int64()), ("chunk", pa.int64()), ("doc_id", pa.int64()), ("ok", pa.bool_()), ("parts", pa.list_(pa.binary()))]
)
FRAGMENT_DDL = "row long, chunk long, doc_id long, ok boolean, parts array<binary>"
DOC_COLUMNS = ("n_a", "n_b", "n_groups", "n_links")
BLOCK = pa.schema(
    [
        ("block", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        *[(c, pa.list_(pa.int64())) for c in DOC_COLUMNS],
        ("groups_sha256", pa.list_(pa.string())),
        ("pairs", pa.binary()),
        ("held", pa.binary()),
        ("docs", pa.binary()),
        ("often", pa.binary()),
    ]
)
BLOCK_DDL = (
    "block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups_sha256 array<string>, pairs binary, held binary, docs binary, often binary"
)
COUNTED = pa.schema(
    [
        ("doc_id", pa.int64()),
        *[(c, pa.int64()) for c in DOC_COLUMNS],
        ("n_best", pa.int64()),
        ("count_sum", pa.int64()),
        ("groups_sha256", pa.string()),
    ]
)
COUNTED_DDL = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


# Tokens


class Tokens(NamedTuple):
    """Ids of both tokenizers and the bytes at which their tokens end."""

    a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray


def _byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level token stands for: printable ones for themselves, the rest from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Both tokenizers with the bytes of every token, and the words seen so far."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte = _byte_level()
        names = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            # Added tokens are text of their own, not byte-level; they never come out of a text.
            self.a_bytes[i] = bytes(byte[c] for c in name) if all(c in byte for c in name) else name.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        # Only then does a piece never reach over a space that follows something else.
        self.separable = not any("▁" in p.lstrip("▁") for p in pieces)
        self.forget()

    def forget(self) -> None:
        self.words: dict[str, int] = {}
        self.flat = (array("i"), array("i"))
        self.counts = (array("i"), array("i"))
        self.ok = (array("b"), array("b"))

    def split(self, text: str) -> list[str]:
        """Words of a text that follows a space: each is tokenized as if it stood alone behind one."""
        if not self.separable:
            return [text]
        if text[:1].isspace() or text[-1:].isspace() or DOUBLE.search(text):
            return BETWEEN.split(text)
        return text.split(" ")

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.words]
        # Words with white space at an end would run into their neighbours.
        plain = [w for w in new if self.separable and w and not w[0].isspace() and not w[-1].isspace()]
        for at in range(0, len(plain), 5_000):
            self._learn_line(plain[at : at + 5_000])
        for word in new:
            if word not in self.words:
                self._learn_one(word)

    def _learn_line(self, words: list[str]) -> None:
        """Words encoded as one line: each begins behind a space, where both tokenizers end a token."""
        line = " " + " ".join(words)
        raw = line.encode()
        stops = np.cumsum([len(w.encode()) + 1 for w in words])
        sides = (self.a.encode(line, add_special_tokens=False).ids, self.b.encode(line[1:], num_threads=1))
        if any(b"".join(map(table.__getitem__, ids)) != raw for ids, table in zip(sides, (self.a_bytes, self.b_bytes))):
            return  # some word does not come back: all are encoded alone
        for side, ids in enumerate(sides):
            ids = np.array(ids, np.int64)
            ends = np.cumsum(self.lengths(side)[ids])
            self.flat[side].frombytes(ids.astype(np.int32).tobytes())
            self.counts[side].frombytes(np.diff(np.searchsorted(ends, stops) + 1, prepend=0).astype(np.int32).tobytes())
            self.ok[side].frombytes(b"\1" * len(words))
        self.words.update(zip(words, range(len(self.words), len(self.words) + len(words))))

    def _learn_one(self, word: str) -> None:
        spaced = " " + word
        sides = (self.a.encode(spaced, add_special_tokens=False).ids, self.b.encode(word))
        for side, (ids, table) in enumerate(zip(sides, (self.a_bytes, self.b_bytes))):
            self.flat[side].extend(ids)
            self.counts[side].append(len(ids))
            self.ok[side].append(b"".join([table[i] for i in ids]) == spaced.encode())
        self.words[word] = len(self.words)

    def tokens(self, side: int, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
        """Ids and byte lengths of the tokens of words, and whether their bytes are the text's."""
        counts = np.frombuffer(self.counts[side], np.int32).astype(np.int64)
        first = np.cumsum(counts) - counts
        own = counts[words]
        at = np.repeat(first[words] - (np.cumsum(own) - own), own) + np.arange(own.sum())
        ids = np.frombuffer(self.flat[side], np.int32)[at].astype(np.int64)
        return ids, self.lengths(side)[ids], bool(np.frombuffer(self.ok[side], np.int8)[words].all())

    @lru_cache  # noqa: B019 - one object a process
    def lengths(self, side: int) -> np.ndarray:
        return np.array([len(x) for x in (self.a_bytes, self.b_bytes)[side]], np.int64)

    def encode_raw(self, text: str) -> tuple[np.ndarray, bool]:
        """Tokens of A of a text that need not follow a space."""
        ids = self.a.encode(text, add_special_tokens=False).ids
        return np.array(ids, np.int64), b"".join([self.a_bytes[i] for i in ids]) == text.encode()


@lru_cache(maxsize=2)
def load(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


# Groups and fragments


class Groups(NamedTuple):
    """Closed groups: all ids of either side in order, and how many of them each group has."""

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray


NO_TOKENS = Tokens(*[np.zeros(0, np.int64)] * 4)
NO_GROUPS = Groups(*[np.zeros(0, np.int64)] * 4)


class Fragment(NamedTuple):
    """Tokens up to the first common end, closed groups from there to the last one, and the tokens behind.

    Without any common end all tokens are in ``prefix`` and ``cut`` is false.
    """

    prefix: Tokens
    closed: Groups
    suffix: Tokens
    cut: bool


def common_ends(t: Tokens) -> np.ndarray:
    if not len(t.a_ends) or not len(t.b_ends):
        return np.zeros(0, np.int64)
    start = min(t.a_ends[0], t.b_ends[0])
    marks = np.zeros(max(t.a_ends[-1], t.b_ends[-1]) - start + 1, bool)
    marks[t.a_ends - start] = True
    return t.b_ends[marks[t.b_ends - start]]


def cut_groups(t: Tokens, ends: np.ndarray) -> Groups:
    """The groups of tokens that close at ``ends``; the last token ends there."""
    at_a, at_b = np.searchsorted(t.a_ends, ends) + 1, np.searchsorted(t.b_ends, ends) + 1
    return Groups(t.a, t.b, np.diff(at_a, prepend=0), np.diff(at_b, prepend=0))


def part(t: Tokens, low: int | None, high: int | None) -> Tokens:
    """The tokens that end behind ``low`` and not behind ``high``."""
    cuts = []
    for ends in (t.a_ends, t.b_ends):
        first = 0 if low is None else np.searchsorted(ends, low, "right")
        last = len(ends) if high is None else np.searchsorted(ends, high, "right")
        cuts.append(slice(first, last))
    return Tokens(t.a[cuts[0]], t.a_ends[cuts[0]], t.b[cuts[1]], t.b_ends[cuts[1]])


def fragment(t: Tokens) -> Fragment:
    ends = common_ends(t)
    if not len(ends):
        return Fragment(t, NO_GROUPS, NO_TOKENS, False)
    first, last = int(ends[0]), int(ends[-1])
    return Fragment(part(t, None, first), cut_groups(part(t, first, last), ends[1:]), part(t, last, None), True)


def joined(x, y):
    return type(x)(*[np.concatenate(pair) for pair in zip(x, y)])


def compose(left: Fragment, right: Fragment) -> Fragment:
    """The fragment of two neighbouring stretches."""
    if not left.cut:
        middle = fragment(joined(left.prefix, right.prefix))
        if not right.cut:
            return middle
        # The last common end of the middle is the first one of the right.
        return Fragment(middle.prefix, joined(middle.closed, right.closed), right.suffix, True)
    middle = joined(left.suffix, right.prefix)
    ends = common_ends(middle)
    if not len(ends):
        return Fragment(left.prefix, left.closed, middle, True)
    last = int(ends[-1])
    closed = joined(left.closed, cut_groups(part(middle, None, last), ends))
    if right.cut:
        return Fragment(left.prefix, joined(closed, right.closed), right.suffix, True)
    return Fragment(left.prefix, closed, part(middle, last, None), True)


def whole_groups(f: Fragment) -> Groups | None:
    """The groups of a document; none if the two tokenizers do not end at one byte."""
    if not f.cut or len(f.suffix.a) or len(f.suffix.b):
        return None
    first = cut_groups(f.prefix, f.prefix.a_ends[-1:])
    return joined(first, f.closed)


def freeze(f: Fragment) -> list[bytes]:
    arrays = [*f.prefix, *f.closed, *f.suffix]
    return [pack(x) if len(x) else b"" for x in arrays] + [b"1" if f.cut else b""]


def thaw(parts: list[bytes]) -> Fragment:
    arrays = [unpack(x, np.int64) if x else np.zeros(0, np.int64) for x in parts[:12]]
    return Fragment(Tokens(*arrays[:4]), Groups(*arrays[4:8]), Tokens(*arrays[8:]), bool(parts[12]))


# Blocks


@lru_cache(maxsize=4)
def _decimals(size: int) -> list[str]:
    return [s + str(i) for s in ("", ",", ";", "|") for i in range(size)]


def digests(g: Groups, first_group: np.ndarray, n_groups: np.ndarray) -> list[str]:
    """The digest of each document's groups as text; documents are runs of groups."""
    size = 1 << int(max(g.a.max(initial=0), g.b.max(initial=0))).bit_length()
    names = _decimals(size)
    start_a, start_b = np.cumsum(g.n_a) - g.n_a, np.cumsum(g.n_b) - g.n_b
    signs_a, signs_b = np.ones(len(g.a), np.int64), np.ones(len(g.b), np.int64)
    signs_a[start_a], signs_b[start_b] = 2, 3
    signs_a[start_a[first_group[n_groups > 0]]] = 0
    # In the text, all tokens of A of a group stand before those of B.
    symbols = np.empty(len(g.a) + len(g.b), np.int64)
    symbols[np.arange(len(g.a)) + np.repeat(start_b, g.n_a)] = signs_a * size + g.a
    symbols[np.arange(len(g.b)) + np.repeat(start_a + g.n_a, g.n_b)] = signs_b * size + g.b
    starts = np.append(start_a + start_b, len(symbols))
    out = []
    for first, n in zip(first_group.tolist(), n_groups.tolist()):
        text = "".join(map(names.__getitem__, symbols[starts[first] : starts[first + n]].tolist()))
        out.append(hashlib.sha256(text.encode()).hexdigest() if n else "")
    return out


def _summed(keys: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(often[order], first) if len(first) else often[:0]


def links(g: Groups, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted (pair, document) keys of all links of the groups, and how often each occurs."""
    sizes = g.n_a * g.n_b
    start_a, start_b = np.cumsum(g.n_a) - g.n_a, np.cumsum(g.n_b) - g.n_b
    keys, often = [], []

    def add(key: np.ndarray, count: np.ndarray | None) -> None:
        if count is None:
            key, count = np.unique(key, return_counts=True)
        keys.append(key)
        often.append(count)

    small = np.flatnonzero(sizes <= LINKS)
    cuts = np.searchsorted(np.cumsum(sizes[small]), np.arange(LINKS, sizes[small].sum() + LINKS, LINKS), "right")
    for some in np.split(small, np.unique(cuts)):
        if not len(some):
            continue
        n_a, n_b = g.n_a[some], g.n_b[some]
        # Tokens of A of these groups, each beside all tokens of B of its group.
        at_a = np.repeat(start_a[some] - (np.cumsum(n_a) - n_a), n_a) + np.arange(n_a.sum())
        wide = np.repeat(n_b, n_a)
        at_b = np.repeat(np.repeat(start_b[some], n_a) - (np.cumsum(wide) - wide), wide) + np.arange(wide.sum())
        own = np.repeat(np.repeat(doc[some], n_a), wide)
        add(((np.repeat(g.a[at_a], wide) << ID_BITS | g.b[at_b]) << DOC_BITS) | own, None)
    for i in np.flatnonzero(sizes > LINKS):
        a, in_a = np.unique(g.a[start_a[i] : start_a[i] + g.n_a[i]], return_counts=True)
        b, in_b = np.unique(g.b[start_b[i] : start_b[i] + g.n_b[i]], return_counts=True)
        for x, n in zip(a, in_a):
            add(((x << ID_BITS | b) << DOC_BITS) | doc[i], n * in_b)
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return _summed(np.concatenate(keys), np.concatenate(often))


def block_row(number: int, ids: list[int | None], n_groups: np.ndarray, g: Groups) -> pa.RecordBatch:
    """A block of documents, each a run of ``n_groups`` groups."""
    first = np.cumsum(n_groups) - n_groups
    bounds = np.append(first, len(g.n_a))
    sums = [np.append(0, np.cumsum(x)) for x in (g.n_a, g.n_b, g.n_a * g.n_b)]
    n_a, n_b, n_links = (s[bounds[1:]] - s[bounds[:-1]] for s in sums)
    keys, often = links(g, np.repeat(np.arange(len(ids)), n_groups))
    pairs, held = np.unique(keys >> DOC_BITS, return_counts=True)
    row = [
        number, ids, n_a, n_b, n_groups, n_links, digests(g, first, n_groups),
        pack_sorted(pairs.astype(np.uint64)) if len(pairs) else b"",
        pack(held.astype(np.int32)) if len(pairs) else b"",
        pack((keys & ((1 << DOC_BITS) - 1)).astype(np.int32)) if len(pairs) else b"",
        pack(often.astype(np.int64)) if len(pairs) else b"",
    ]
    return pa.record_batch([pa.array([v], f.type) for v, f in zip(row, BLOCK)], schema=BLOCK)


def short_block(pair: Pair, number: int, ids: list[int | None], texts: list[str | None]) -> pa.RecordBatch:
    """A block of short documents, tokenized here."""
    split = [pair.split(t) if t else [] for t in texts]
    new = set().union(*map(set, split))
    if len(pair.words) + len(new) > REMEMBERED:
        pair.forget()
    pair.learn(new)
    rows = [np.fromiter(map(pair.words.__getitem__, s), np.int64, len(s)) for s in split]
    good = np.frombuffer(pair.ok[0], np.int8) & np.frombuffer(pair.ok[1], np.int8)
    rows = [r if good[r].all() else r[:0] for r in rows]
    words = np.concatenate(rows)
    n_groups = np.zeros(len(ids), np.int64)
    if not len(words):
        return block_row(number, ids, n_groups, NO_GROUPS)
    (a, a_lengths, _), (b, b_lengths, _) = pair.tokens(0, words), pair.tokens(1, words)
    tokens = Tokens(a, np.cumsum(a_lengths), b, np.cumsum(b_lengths))
    ends = common_ends(tokens)
    # Bytes of each document: both tokenizers end with it.
    counts = np.frombuffer(pair.counts[0], np.int32)
    last = np.cumsum([int(counts[r].sum()) for r in rows])
    stops = np.where(last > 0, tokens.a_ends[np.maximum(last - 1, 0)], 0)
    n_groups = np.diff(np.searchsorted(ends, stops, "right"), prepend=0)
    return block_row(number, ids, n_groups, cut_groups(tokens, ends))


def _short(a_path: str, b_path: str, block_bytes: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, number = load(a_path, b_path), TaskContext.get().partitionId() << 24
        ids, texts, total = [], [], 0
        for rows in parts:
            for doc, value in zip(rows.column("doc_id").to_pylist(), rows.column("text")):
                ids.append(doc)
                texts.append(text := value.as_py())
                total += len(text or "") + 1
                if total >= block_bytes or len(ids) + 1 >= 1 << DOC_BITS:
                    yield short_block(pair, number, ids, texts)
                    ids, texts, total, number = [], [], 0, number + 1
        if ids:
            yield short_block(pair, number, ids, texts)

    return run


# Long documents


def cut_text(pair: Pair, text: str, size: int) -> list[tuple[str, str]]:
    """Ranges of about ``size`` characters of a space and the text, as (for A, for B): each side cut at its own places."""
    spaced, sides = " " + text, []
    for pattern in (AFTER_LETTER, BETWEEN):
        cuts, at = [0], size
        while pair.separable and at < len(spaced) and (found := pattern.search(spaced, at)):
            cuts.append(found.start())
            at = max(found.start() + 1, (len(cuts)) * size)
        sides.append(cuts + [len(spaced)])
    # One side may have fewer places to cut; its last ranges are empty then.
    n = max(map(len, sides))
    a, b = ([*s, *[len(spaced)] * (n - len(s))] for s in sides)
    return [(spaced[a[i] : a[i + 1]], spaced[b[i] : b[i + 1]]) for i in range(n - 1)]


def _chunker(a_path: str, b_path: str, chunk_bytes: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = load(a_path, b_path)
        for rows in parts:
            for row, doc, text in zip(*(rows.column(c).to_pylist() for c in ("row", "doc_id", "text"))):
                at_a = at_b = 0
                for i, (a, b) in enumerate(cut_text(pair, text, chunk_bytes)):
                    values = [row, i, doc, at_a, at_b, a, b]
                    yield pa.record_batch([pa.array([v], t) for v, t in zip(values, CHUNK_TYPES)], names=CHUNK_NAMES)
                    at_a, at_b = at_a + len(a.encode()), at_b + len(b.encode())

    return run


CHUNK_DDL = "row long, chunk long, doc_id long, at_a long, at_b long, a string, b string"
CHUNK_NAMES = [c.split()[0] for c in CHUNK_DDL.split(", ")]
CHUNK_TYPES = [pa.int64()] * 5 + [pa.string()] * 2


def chunk_fragment(pair: Pair, at_a: int, at_b: int, a: str, b: str) -> tuple[Fragment, bool]:
    """The fragment of a range that A's text starts at byte ``at_a`` and B's at ``at_b``."""
    # A's range may start within a line: up to the first place before a space its text stands alone.
    head, rest = ("", a[1:]) if a[:1] == " " and a[1:2].strip() else (a, "")
    if not rest and head and (found := BETWEEN.search(head)) and pair.separable:
        head, rest = head[: found.start()], head[found.start() + 1 :]
    if len(pair.words) > REMEMBERED:
        pair.forget()
    words_a, words_b = pair.split(rest) if rest else [], pair.split(b[1:]) if b[1:] else []
    pair.learn({*words_a, *words_b})
    number = [np.fromiter(map(pair.words.__getitem__, w), np.int64, len(w)) for w in (words_a, words_b)]
    first, good = pair.encode_raw(head)
    (a_ids, a_lengths, good_a), (b_ids, b_lengths, good_b) = pair.tokens(0, number[0]), pair.tokens(1, number[1])
    a_ids, a_lengths = np.concatenate([first, a_ids]), np.concatenate([pair.lengths(0)[first], a_lengths])
    tokens = Tokens(a_ids, at_a + np.cumsum(a_lengths), b_ids, at_b + np.cumsum(b_lengths))
    return fragment(tokens), good and good_a and good_b


def _fragments(a_path: str, b_path: str):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = load(a_path, b_path)
        for rows in parts:
            out = []
            for r in rows.to_pylist():
                found, good = chunk_fragment(pair, r["at_a"], r["at_b"], r["a"], r["b"])
                out.append({"row": r["row"], "chunk": r["chunk"], "doc_id": r["doc_id"], "ok": good, "parts": freeze(found)})
            yield pa.RecordBatch.from_pylist(out, schema=FRAGMENT)

    return run


def _composed(table: pa.Table) -> pa.Table:
    rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
    whole = reduce(compose, [thaw(r["parts"]) for r in rows])
    first = rows[0]
    out = {c: first[c] for c in ("row", "doc_id")} | {"chunk": first["chunk"] // FAN, "ok": all(r["ok"] for r in rows)}
    return pa.Table.from_pylist([out | {"parts": freeze(whole)}], schema=FRAGMENT)


def _long_blocks(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in parts:
        for r in rows.to_pylist():
            groups = whole_groups(thaw(r["parts"])) if r["ok"] else None
            n = np.array([len(groups.n_a) if groups else 0])
            yield block_row(-1 - r["row"], [r["doc_id"]], n, groups or NO_GROUPS)


def long_fragments(long: DataFrame, a_path: str, b_path: str, chunk_bytes: int) -> DataFrame:
    """One fragment a document, composed from those of its ranges level by level."""
    numbered = long.withColumn("row", F.monotonically_increasing_id())
    chunks = materialise(numbered.mapInArrow(_chunker(a_path, b_path, chunk_bytes), CHUNK_DDL))
    # Ranges of one document go to different tasks.
    found = chunks.repartition("row", "chunk").mapInArrow(_fragments(a_path, b_path), FRAGMENT_DDL)
    left = (chunks.agg(F.max("chunk")).first()[0] or 0) + 1
    while left > 1:
        found = found.groupBy("row", F.floor(F.col("chunk") / FAN)).applyInArrow(_composed, FRAGMENT_DDL)
        left = -(-left // FAN)
    return found


# Counts


def _pairs(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in parts:
        for block, pairs, held in zip(*(rows.column(c).to_pylist() for c in ("block", "pairs", "held"))):
            if pairs:
                own = unpack_sorted(pairs).view(np.int64)
                counts = unpack(held, np.int32).astype(np.int64)
                yield pa.record_batch(
                    [pa.array(np.full(len(own), block)), pa.array(own), pa.array(counts)], names=["block", "pair", "held"]
                )


def _exact_sums(places: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    # Float sums of halves below 2^26 stay exact for 2^27 of them.
    low, high = values & ((1 << 26) - 1), values >> 26
    sums = [np.bincount(places, x, size).astype(np.int64) for x in (low, high)]
    return sums[0] + (sums[1] << 26)


def _count(blocks: pa.Table, counts: pa.Table) -> pa.Table:
    out = []
    for r in blocks.to_pylist():
        size = len(r["doc_ids"])
        n_best = count_sum = np.zeros(size, np.int64)
        if r["pairs"]:
            order = np.argsort(counts.column("pair").to_numpy())
            count, best = (counts.column(c).to_numpy()[order] for c in ("count", "best"))
            held, docs, often = unpack(r["held"], np.int32), unpack(r["docs"], np.int32), unpack(r["often"], np.int64)
            count_sum = _exact_sums(docs, np.repeat(count, held) * often, size)
            n_best = _exact_sums(docs, np.repeat(best, held) * often, size)
        columns = [r["doc_ids"], *[r[c] for c in DOC_COLUMNS], n_best, count_sum, r["groups_sha256"]]
        out.append(pa.table([pa.array(c, f.type) for c, f in zip(columns, COUNTED)], schema=COUNTED))
    return pa.concat_tables(out) if out else COUNTED.empty_table()


def aligned_blocks(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    id_column: str = "doc_id",
    text: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Write all documents' groups in blocks: digests and sizes by document, links by (pair, document)."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    size: Column = F.coalesce(F.octet_length("text"), F.lit(0))
    short = rows.where(size <= chunk_bytes).mapInArrow(_short(a_path, b_path, block_bytes), BLOCK_DDL)
    long = long_fragments(rows.where(size > chunk_bytes), a_path, b_path, chunk_bytes).mapInArrow(_long_blocks, BLOCK_DDL)
    return materialise(short).unionByName(materialise(long))


def pair_counts(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(block, pair, held) and (pair, count, best): documents that hold a pair, and whether no pair of its A id has more."""
    rows = materialise(blocks.select("block", "pairs", "held").mapInArrow(_pairs, "block long, pair long, held long"))
    counts = materialise(rows.groupBy("pair").agg(F.sum("held").alias("count")))
    counts = counts.withColumn("a", F.shiftright("pair", ID_BITS))
    # One row for each id of A's vocabulary at most, whatever the corpus: fit to broadcast.
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    best = (F.col("count") == F.col("most")).cast("long").alias("best")
    return rows, counts.join(F.broadcast(most), "a").select("pair", "count", best)


def align_tokenizers(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    id_column: str = "doc_id",
    text: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Return doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256, one row per input row.

    ``a_path`` is a byte-level tokenizer (.json), ``b_path`` a sentence-piece
    model that adds a space in front; special tokens' strings are plain text.
    Documents whose tokens of either side do not give a space and the text back,
    byte for byte, have no tokens: zeros and an empty digest. So do missing and
    empty texts. Repeated rows, also under one id or none, are documents of
    their own and count as such. Empty tables give an empty result.
    """
    blocks = aligned_blocks(docs, a_path, b_path, id_column, text, chunk_bytes, block_bytes)
    rows, counts = pair_counts(blocks)
    back = rows.drop("held").join(counts, "pair")
    grouped = blocks.groupBy("block").cogroup(back.groupBy("block"))
    return grouped.applyInArrow(_count, COUNTED_DDL)
