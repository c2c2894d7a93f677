"""Byte-level BPE in a stream: tokens are emitted as soon as no later byte can change them.

A text passes two stages, both of which hold a bounded number of characters. The splitter cuts it
into the pieces that the merges never cross; the transducer merges a piece from left to right in
windows. How many bytes beyond a token must be known before it is final follows from the merge list
(`sufficient_lookahead`), so a piece of any length, such as a run of letters without a space, is
encoded in a window of that size, and the result is the same as with the whole piece at once. Pieces
of usual length are remembered, in a table of bounded size.

Decoding is a state machine from bytes to text: of a token's bytes, an unfinished character waits
for the next token. Invalid bytes become U+FFFD, one for each maximal part of a character.

Defined results: null is the empty text, which has no tokens; the string of a special token in a
text is that token; repeated rows are encoded each; all columns of the input are kept,
but for those named like an added one.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import sys
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlark.llm.common import shield, unshield

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The pattern that splits text before the merges (fixed value of the vocabulary's format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# One character of a run, by the class that a long piece consists of.
RUNS = {"letters": r"\p{L}+", "numbers": r"\p{N}+", "blanks": r"\s+", "others": r"[^\s\p{L}\p{N}]+"}

BLOCK = 1 << 16  # characters that are read at a time
LONG_PIECE = 1 << 10  # a piece of more characters is encoded in windows
REMEMBERED = 1 << 18  # pieces whose tokens are kept, and as many of before


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes stand for
    themselves, the others for the code points from 256 on, in order."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes that must be known beyond the end of a token for the token to be final.

    Compare the merges of a text with those of the same text and more behind it. In order of rank,
    the first merge that differs reaches beyond the known end and begins at most its length less one
    before it. A difference moves to the left only if a merge (t, s) happens in one run alone, where s
    begins at the leftmost difference so far: then an earlier merge (u, v), with s = u or s = uv,
    happened there in one run alone, and the difference moves by the length of t. So the distance is
    at most that of the heaviest chain of merges of rising rank linked in this way. Restarting at
    a final token's end is right, as no merge crosses it.
    """
    reach: dict[bytes, int] = {}  # by s: the farthest difference whose leftmost token may be s
    most = 0
    for u, v in merges:
        far = max(len(u) + len(v) - 1, len(u) + reach.get(v, -len(u)))
        most = max(most, far)
        for s in (u, u + v):
            if reach.get(s, 0) < far:
                reach[s] = far
    return most


class Vocabulary:
    """Merges, ids and special tokens of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        letters = byte_letters()
        as_bytes = {t: bytes(letters[c] for c in t) for t in file["model"]["vocab"] if all(c in letters for c in t)}
        self.ids = {b: file["model"]["vocab"][t] for t, b in as_bytes.items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in file["model"]["merges"]]
        self.merges = [tuple(bytes(letters[c] for c in part) for part in pair) for pair in pairs]
        self.ranks = {pair: rank for rank, pair in enumerate(self.merges)}
        made = {u + v: rank for rank, (u, v) in enumerate(self.merges)}
        if len(made) != len(self.merges) or any(
            made.get(part, -1) >= rank for rank, pair in enumerate(self.merges) for part in pair
        ):
            raise ValueError("a merge must come after those that make its parts, and make a token of its own")
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.bytes = {i: b for b, i in self.ids.items()} | {i: t.encode() for t, i in self.special.items()}
        self.lookahead = sufficient_lookahead(self.merges)
        self.pattern = regex.compile(PATTERN)
        self.runs = {name: regex.compile(run) for name, run in RUNS.items()}
        self.special_pattern = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.special_length = max(map(len, self.special), default=0)
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def merged(self, piece: bytes) -> list[bytes]:
        """Tokens of a piece: the pair of lowest rank is merged first, and of equals the leftmost."""
        parts: list[bytes | None] = [piece[i : i + 1] for i in range(len(piece))]
        if len(parts) < 2:
            return parts
        after = [*range(1, len(parts)), -1]
        before = [-1, *range(len(parts) - 1)]
        ranks = self.ranks
        queue = [(ranks[p], i) for i in range(len(parts) - 1) if (p := (parts[i], parts[i + 1])) in ranks]
        heapq.heapify(queue)
        while queue:
            rank, i = heapq.heappop(queue)
            j = after[i] if parts[i] is not None else -1
            if j < 0 or ranks.get((parts[i], parts[j])) != rank:
                continue
            parts[i], parts[j] = parts[i] + parts[j], None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] >= 0 and (r := ranks.get((parts[left], parts[after[left]]))) is not None:
                    heapq.heappush(queue, (r, left))
        return [p for p in parts if p is not None]

    def piece_ids(self, piece: str) -> tuple[int, ...]:
        found = self.known.get(piece)
        if found is None:
            if len(self.known) >= REMEMBERED:  # what is not met again is forgotten
                self.older = dict(self.known)
                self.known.clear()
            found = self.older.get(piece) or tuple(self.ids[t] for t in self.merged(piece.encode()))
            self.known[piece] = found
        return found


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """Read once by a Python worker."""
    return Vocabulary(path)


class Transducer:
    """Tokens of one long piece, fed in parts."""

    def __init__(self, v: Vocabulary):
        self.v, self.rest, self.window = v, b"", 2 * v.lookahead + 1024

    def feed(self, part: bytes) -> list[int]:
        out: list[int] = []
        self.rest += part
        while len(self.rest) >= self.window:
            stable, end = self.window - self.v.lookahead, 0
            for token in self.v.merged(self.rest[: self.window]):
                if end + len(token) > stable:
                    break
                out.append(self.v.ids[token])
                end += len(token)
            self.rest = self.rest[end:]
        return out

    def finish(self) -> list[int]:
        tokens, self.rest = self.v.merged(self.rest), b""
        return [self.v.ids[t] for t in tokens]


class Encoder:
    """Ids of a text that is fed in blocks. Held back: what the next characters may still change."""

    def __init__(self, v: Vocabulary):
        self.v, self.held, self.long, self.run = v, "", None, None

    def feed(self, block: str) -> Iterator[Iterable[int]]:
        self.held += block
        v = self.v
        while v.special_pattern and (m := v.special_pattern.search(self.held)):
            after, self.held = self.held[m.end() :], self.held[: m.start()]
            yield from self._pieces(len(self.held), last=True)
            self.held = after
            yield (v.special[m.group()],)
        yield from self._pieces(len(self.held) - max(0, v.special_length - 1), last=False)

    def finish(self) -> Iterator[Iterable[int]]:
        yield from self._pieces(len(self.held), last=True)

    def _pieces(self, end: int, last: bool) -> Iterator[Iterable[int]]:
        """Pieces up to `end` of what is held. Before the last block, the final match and whatever
        ends less than 3 characters before `end` may still change."""
        if self.long:
            end = yield from self._go_on(end, last)
            if self.long:
                return
        text, v = self.held[: max(0, end)], self.v
        known, out, done = v.known, [], 0
        if last:
            matches = v.pattern.findall(text)
            done = len(text)
        else:
            matches = v.pattern.findall(text)
            stable = len(text)
            while matches and stable > len(text) - 3:
                stable -= len(matches.pop())
            if matches:
                stable -= len(matches.pop())
            done = stable
        for piece in matches:
            if len(piece) > LONG_PIECE:
                yield out
                whole = Transducer(v)
                for i in range(0, len(piece), LONG_PIECE):
                    yield whole.feed(piece[i : i + LONG_PIECE].encode())
                yield whole.finish()
                out = []
            else:
                out += known.get(piece) or v.piece_ids(piece)
        if out:
            yield out
        self.held = self.held[done:]
        if not last and end - done > 2 * LONG_PIECE:
            yield from self._begin_long(end - done)

    def _begin_long(self, end: int) -> Iterator[Iterable[int]]:
        """The held text begins with a run that may go on: enter it if it is long."""
        m = self.v.pattern.match(self.held[:end])
        if m and m.end() > LONG_PIECE:
            piece = m.group()
            self.run = next(n for n, r in self.v.runs.items() if r.match(piece[-1]))
            first = 0 if self.run == "blanks" or piece[0] != " " else 1
            self.long = Transducer(self.v)
            yield self.long.feed(piece[:first].encode())
            self.held = self.held[first:]
            yield from self._go_on(end - first, last=False)

    def _go_on(self, end: int, last: bool):
        """Feeds the run that has begun; a run of blanks keeps its last one back, as it belongs to
        the next piece if there is one. Returns what is left of `end`."""
        m = self.v.runs[self.run].match(self.held, 0, max(0, end))
        run = m.end() if m else 0
        over = last or run < end
        keep = 0
        if self.run == "blanks":
            keep = min(run, 0 if last and run == len(self.held[:end]) else 1)
        take = max(0, run - keep)
        yield self.long.feed(self.held[:take].encode())
        self.held = self.held[take:]
        if over:
            yield self.long.finish()
            self.long = None
        return end - take


def encode(text: str, v: Vocabulary, block: int = BLOCK) -> Iterator[Iterable[int]]:
    """Groups of ids, in order."""
    encoder = Encoder(v)
    for i in range(0, len(text), block):
        yield from encoder.feed(text[i : i + block])
    yield from encoder.finish()


class Decoder:
    """Text of ids that are fed in groups."""

    def __init__(self, v: Vocabulary):
        self.bytes, self.state = v.bytes, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.state.decode(b"".join(map(self.bytes.__getitem__, ids)))

    def finish(self) -> str:
        return self.state.decode(b"", final=True)


def round_trip(text: str, v: Vocabulary) -> tuple[int, str, str]:
    """(number of ids, digest of the ids, digest of the decoded text), in constant memory."""
    ids_digest, text_digest, decoder, n = hashlib.sha256(), hashlib.sha256(), Decoder(v), 0
    for ids in encode(text, v):
        if ids:
            ids_digest.update(((",%d" * len(ids)) % tuple(ids)).encode()[0 if n else 1 :])
            n += len(ids)
            text_digest.update(decoder.feed(ids).encode())
    text_digest.update(decoder.finish().encode())
    return n, ids_digest.hexdigest(), text_digest.hexdigest()


def with_ids(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """`df` with ids (array of int): the tokens of the whole text."""
    df, names = shield(df, text)

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        v = vocabulary(path)
        return pd.Series([[i for group in encode(t or "", v) for i in group] for t in texts])

    return unshield(df.withColumn("ids", ids(F.col(text))), names)


def with_text(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """`df` with decoded: the text of the ids; null ids are the empty text."""
    df, names = shield(df, ids)

    @F.pandas_udf("string")
    def text(lists: pd.Series) -> pd.Series:
        v, out = vocabulary(path), []
        for given in lists:
            decoder = Decoder(v)
            out.append(decoder.feed(given if given is not None else ()) + decoder.finish())
        return pd.Series(out)

    return unshield(df.withColumn("decoded", text(F.col(ids))), names)


def with_round_trip(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """`df` with n_tokens, ids_sha256 (of the decimal ids, joined by commas) and decoded_sha256."""
    df, names = shield(df, text)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def told(texts: pd.Series) -> pd.DataFrame:
        v = vocabulary(path)
        return pd.DataFrame([round_trip(t or "", v) for t in texts], columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return unshield(df.withColumn("_told", told(F.col(text))).select(*df.columns, "_told.*"), names)
