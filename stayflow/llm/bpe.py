"""Byte-level BPE: exact encoding by backtracking over longest matches.

Each piece of text (a match of the vocabulary's split pattern) is encoded
without running merges: an Aho-Corasick automaton over the token bytes (bytes
mapped to Latin-1 characters) gives the longest token that starts at each
position; the encoder walks left to right taking longest matches, and where two
neighbours could not stand side by side in a merged text it tries the next
shorter prefix token or steps back.  Whether two tokens may be neighbours is
decided from their merge histories and memoised.  A position found to be a dead
end is never entered again, so a piece takes linear time.

Null text is the empty text: no ids, empty bytes.  Null doc_id stays null.
Repeated rows give repeated results.  Special tokens are ordinary text.
"""

from __future__ import annotations

import base64
from functools import lru_cache
from itertools import chain

import ahocorasick
import regex
from pyspark.sql import DataFrame

from .common import id_text, map_rows, sha256

# Entries that each memo of a Python worker keeps.
MEMO_ENTRIES = 250_000


def read_ranks(path: str) -> bytes:
    """Content of a rank file (bounded by the vocabulary, sent to the tasks)."""
    with open(path, "rb") as f:
        return f.read()


class Memo:
    """At most ``entries`` results, in two generations: what is asked for
    moves to the young one; when that is half of all, it becomes the old one, and the
    old one is forgotten.  So frequent words stay."""

    def __init__(self, entries: int):
        self.half, self.young, self.old = max(1, entries // 2), {}, {}

    def get(self, key: str) -> tuple[int, ...] | None:
        known = self.young.get(key)
        if known is None:
            known = self.old.get(key)
            if known is not None:
                self.put(key, known)
        return known

    def put(self, key: str, value: tuple[int, ...]) -> None:
        if len(self.young) >= self.half:
            self.young, self.old = {}, self.young
        self.young[key] = value


class Encoder:
    def __init__(self, ranks_file: bytes, pattern: str):
        pairs = [line.split() for line in ranks_file.splitlines() if line.strip()]
        self.ranks = {base64.b64decode(t): int(r) for t, r in pairs}
        self.bytes_of = {r: t for t, r in self.ranks.items()}
        self.text_of = {r: str(r) for r in self.bytes_of}
        self.find = regex.compile(pattern).findall
        # A space beside other white space, or at either end of the text.
        self.odd_space = regex.compile(r"\s[ ]|[ ]\s|^[ ]|[ ]\Z").search
        self.halves: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        self.shorter: dict[int, int] = {}
        self.fits_memo: dict[int, bool] = {}
        self.sizes = {r: len(t) for r, t in self.bytes_of.items()}
        self.piece_memo, self.unit_memo = Memo(MEMO_ENTRIES), Memo(MEMO_ENTRIES)
        self._build()

    def _build(self) -> None:
        """Merge history of every token, in rank order; tokens that merging
        never produces stay out of the automaton (they can only be a whole
        piece)."""
        made = set()
        for rank in sorted(self.bytes_of):
            token = self.bytes_of[rank]
            if len(token) == 1:
                self.halves[rank] = (rank, rank)
                made.add(rank)
                continue
            for cut in range(len(token) - 1, 0, -1):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a in made and b in made and self._neighbours(a, b):
                    self.halves[rank] = (a, b)
                    self.joined[a, b] = rank
                    made.add(rank)
                    break
        self.automaton = ahocorasick.Automaton()
        for rank in made:
            token = self.bytes_of[rank]
            self.automaton.add_word(token.decode("latin-1"), (rank, len(token)))
            for cut in range(len(token) - 1, 0, -1):
                if (p := self.ranks.get(token[:cut])) in made:
                    self.shorter[rank] = p
                    break
        self.automaton.make_automaton()

    def _neighbours(self, a: int, b: int) -> bool:
        """May a and b stand side by side?  Undo the later merge of the two,
        again and again; they may unless the facing parts would have merged
        before one of the merges undone so far."""
        before = float("inf")
        while True:
            made = self.joined.get((a, b))
            if made is not None and made < before:
                return False
            # The right part's merge counts as later on equal rank: of two
            # equal pairs, the left one merges first.
            for left in ((True, False) if a > b else (False, True)):
                part = a if left else b
                halves = self.halves[part]
                if halves[0] != part:
                    before = part if left else part + 1
                    a, b = (halves[1], b) if left else (a, halves[0])
                    break
            else:
                return True

    def fits(self, a: int, b: int) -> bool:
        memo, key = self.fits_memo, a << 32 | b
        known = memo.get(key)
        if known is None:
            if len(memo) >= MEMO_ENTRIES:
                memo.clear()
            known = memo[key] = self._neighbours(a, b)
        return known

    def piece(self, text: str) -> tuple[int, ...]:
        known = self.piece_memo.get(text)
        if known is None:
            data = text.encode()
            whole = self.ranks.get(data)
            known = (whole,) if whole is not None else tuple(self._walk(data))
            self.piece_memo.put(text, known)
        return known

    def _walk(self, data: bytes) -> list[int]:
        n = len(data)
        longest = [0] * n
        for end, (rank, size) in self.automaton.iter(data.decode("latin-1")):
            longest[end - size + 1] = rank
        open_ = bytearray(b"\x01") * (n + 1)
        ids: list[int] = []
        at, token, last = 0, longest[0], -1
        sizes, shorter, known, fits = self.sizes, self.shorter, self.fits_memo.get, self.fits
        while True:
            while True:
                end = at + sizes[token]
                fit = open_[end]
                if fit and last >= 0:
                    fit = known(last << 32 | token)
                    if fit is None:
                        fit = fits(last, token)
                if fit:
                    ids.append(token)
                    if end == n:
                        return ids
                    last, at, token = token, end, longest[end]
                    break
                less = shorter.get(token)
                if less is None:
                    open_[at] = 0
                    token = ids.pop()
                    at -= sizes[token]
                    last = ids[-1] if ids else -1
                    break
                token = less

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text.

        A single space between two non-space characters always starts a new
        piece, so such texts are cut there and the stretches memoised; any
        other text is cut by the pattern alone.
        """
        ids: list[int] = []
        if not text:
            return ids
        if self.odd_space(text):
            for p in self.find(text):
                ids.extend(self.piece(p))
            return ids
        units = text.split(" ")
        for p in self.find(units[0]):
            ids.extend(self.piece(p))
        known = list(map(self.unit_memo.young.get, units[1:]))
        for k, found in enumerate(known, 1):
            if found is None:
                known[k - 1] = self.unit(units[k])
        ids.extend(chain.from_iterable(known))
        return ids

    def unit(self, u: str) -> tuple[int, ...]:
        """Ids of a space and the stretch after it."""
        known = self.unit_memo.get(u)
        if known is None:
            found = self.find(" " + u)
            known = self.piece(found[0]) if len(found) == 1 else tuple(i for p in found for i in self.piece(p))
            if len(u) < 200:
                self.unit_memo.put(u, known)
        return known

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def ids_text(self, ids: list[int]) -> bytes:
        return ",".join(map(self.text_of.__getitem__, ids)).encode()


@lru_cache(maxsize=2)
def encoder(ranks_file: bytes, pattern: str) -> Encoder:
    """One encoder in each Python worker, kept from task to task."""
    return Encoder(ranks_file, pattern)


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id, ids: the token ids of every text."""
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def make():
        enc = encoder(ranks.value, pattern)
        return lambda doc, text: (doc, enc.encode(text or ""))
    return map_rows(id_text(docs, id_col, text_col), make, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, data: the bytes that the ids stand for (null ids: none)."""
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def make():
        enc = encoder(ranks.value, pattern)
        return lambda doc, ids: (doc, enc.decode(ids or []))
    return map_rows(encoded.select("doc_id", "ids"), make, "doc_id long, data binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = False, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Encode and decode in one pass over the texts: digests of both results,
    and the ids themselves if asked for."""
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def make():
        enc = encoder(ranks.value, pattern)

        def row(doc, text):
            ids = enc.encode(text or "")
            found = doc, len(ids), sha256(enc.ids_text(ids)), sha256(enc.decode(ids))
            return (*found, ids) if with_ids else found
        return row
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_rows(id_text(docs, id_col, text_col), make, schema + ", ids array<int>" * with_ids)
