"""Byte-level BPE encoding and decoding by backtracking from longest matches.

A text is split by the tokenizer's pattern; each piece is encoded on its own.  The token bytes are
mapped one to one to Latin-1 characters, which gives an automaton that reports the tokens at
every place of a piece.  The encoder takes the longest token at each place and steps back to
shorter ones until neighbouring tokens are compatible: a pair is compatible when merging
its joined bytes by rank gives exactly that pair.  Pairs are memoised, places that failed are
never tried again, so a piece takes linear time, and the result equals the merges by rank.

Null texts count as empty; an empty text has no ids and decodes to no bytes.  Rows are independent, so
repeated rows, null ids and further columns change nothing; an empty table gives an empty result."""

from __future__ import annotations

import base64
import functools
import hashlib
import re

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.texts import bounded_batches
from sluice.session import ship


#: Pieces, and words, that a worker remembers at most.
CACHED = 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Encoder:
    """``cached`` pieces and as many words are remembered at most."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cached: int = CACHED):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.length = [len(self.tokens.get(rank, b"")) for rank in range(max(self.tokens, default=-1) + 1)]
        self.automaton = ahocorasick.Automaton()
        # Tokens that merging does not reach only ever stand for a whole piece.
        reached = {token for token, rank in ranks.items() if self.merge(token) == [rank]}
        for token in reached:
            self.automaton.add_word(token.decode("latin-1"), ranks[token])
        self.automaton.make_automaton()
        self.shorter = {ranks[t]: next((ranks[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in reached), -1)
                        for t in reached}
        self.fits = _Memo(self._compatible, 1_000_000)
        self.piece_ids = _Memo(self._piece_ids, cached)
        self.word_ids = _Memo(lambda word: self._ids(" " + word), cached)
        self.data_of = _Memo(self._data_of, cached)

    def merge(self, data: bytes) -> list[int]:
        """Merges neighbours, the lowest rank first: the definition, for short inputs."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 60))
            if parts[best] + parts[best + 1] not in self.ranks:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return [self.ranks[p] for p in parts]

    def _compatible(self, pair: tuple[int, int]) -> bool:
        return self.merge(self.tokens[pair[0]] + self.tokens[pair[1]]) == [*pair]

    def encode_piece(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        letters, fits = data.decode("latin-1"), self.fits
        chosen = [rank for _, rank in self.automaton.iter_long(letters)]
        if all(map(fits.__getitem__, zip(chosen, chosen[1:]))):
            return chosen
        length, shorter, size = self.length, self.shorter, len(data)
        longest = [0] * (size + 1)
        for last, rank in self.automaton.iter(letters):  # longer ones come later
            longest[last + 1 - length[rank]] = rank
        dead = bytearray(size + 1)
        chosen, at, rank = [], 0, longest[0]
        while at < size:
            end = at + length[rank]
            if not dead[end] and (not at or fits[chosen[-1], rank]):
                chosen.append(rank)
                at, rank = end, longest[end]
            elif shorter[rank] >= 0:
                rank = shorter[rank]
            else:  # nothing fits here: give up the place, and with it the token before
                dead[at] = 1
                rank = chosen.pop()
                at -= length[rank]
        return chosen

    def _piece_ids(self, piece: str) -> str:
        return ",".join(map(str, self.encode_piece(piece.encode("utf-8", "surrogatepass"))))

    def _ids(self, text: str) -> str:
        return ",".join(map(self.piece_ids.__getitem__, self.pattern.findall(text)))

    def encode(self, text: str | None, step: int = 1 << 20):
        """Decimal ids joined by commas, as lists of strings.  Before a single space a piece
        always ends, so words with the space before them are looked up whole; a text with
        other runs of spaces is split by the pattern, cut between two letters or digits when long."""
        text = text or ""
        if "  " in text or text.endswith(" "):
            at = 0
            while at < len(text):
                cut = _CUT.search(text, at + step)
                end = cut.start() + 1 if cut else len(text)
                yield list(map(self.piece_ids.__getitem__, self.pattern.findall(text, at, end)))
                at = end
            return
        at = 0
        while at < len(text):
            end = text.find(" ", at + step)
            end = len(text) if end < 0 else end
            first, *words = text[at:end].split(" ")
            ids = list(map(self.word_ids.__getitem__, words))
            yield [self._ids(first), *ids] if first else ids
            at = end

    def _data_of(self, ids: str) -> bytes:
        return b"".join(self.tokens[int(i)] for i in ids.split(","))

    def decode(self, ids: list[str]) -> bytes:
        """The bytes of the ids in a list as ``encode`` yields it."""
        return b"".join(map(self.data_of.__getitem__, ids))


_CUT = re.compile(r"[^\W_] [^\W_]")


class _Memo(dict):
    """Remembers results of short keys; starts again when full."""

    def __init__(self, make, most: int, longest: int = 64):
        super().__init__()
        self.make, self.most, self.longest = make, most, longest

    def __missing__(self, key: str):
        made = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[key] = made
        return made


@functools.lru_cache(maxsize=2)
def _encoder(path: str, pattern: str, cached: int = CACHED) -> Encoder:
    return Encoder(read_ranks(path), pattern, cached)


def _digest(encoder: Encoder, text: str | None) -> tuple[int, str, str]:
    ids_hash, data_hash, n = hashlib.sha256(), hashlib.sha256(), 0
    for ids in encoder.encode(text):
        part = ",".join(ids)
        ids_hash.update(("," + part if n else part).encode())
        data_hash.update(encoder.decode(ids))
        n += part.count(",") + 1
    return n, ids_hash.hexdigest(), data_hash.hexdigest()


def _rows(docs: DataFrame) -> DataFrame:
    ship(docs.sparkSession)
    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def token_digests(docs: DataFrame, path: str, pattern: str, cached: int = CACHED) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row; the decoded bytes come
    from the ids alone.  ``cached`` bounds what a worker remembers: less memory, more work."""
    def batches(found):
        encoder = _encoder(path, pattern, cached)
        for batch in found:
            n, ids, data = zip(*(_digest(encoder, t.as_py()) for t in batch["text"])) if len(batch) else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(data, pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _rows(docs).mapInArrow(batches, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids array<int>) of every row."""
    def batches(found):
        encoder = _encoder(path, pattern)
        for batch in found:
            ids = [[int(i) for part in encoder.encode(t.as_py()) for word in part for i in word.split(",")] for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return _rows(docs).mapInArrow(batches, "doc_id long, ids array<int>")


def decoded(ids: DataFrame, path: str) -> DataFrame:
    """(doc_id, data binary) of (doc_id, ids) rows; null ids give no bytes."""
    def batches(found):
        tokens = {rank: token for token, rank in read_ranks(path).items()}
        for batch in found:
            data = [b"".join(tokens[i] for i in x.as_py() or ()) for x in batch["ids"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(data, pa.binary())], ["doc_id", "data"])

    ship(ids.sparkSession)
    return ids.select("doc_id", "ids").mapInArrow(batches, "doc_id long, data binary")
