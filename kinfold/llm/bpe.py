"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece there is exactly one token that can end its BPE encoding: the token of
the vocabulary that is a suffix of the prefix and may follow the last token of what stands before
it.  Two tokens may stand side by side if undoing their merges step by step never shows a pair that
BPE would have merged across the border first.  So one stored token a prefix is enough: bytes can
be appended at constant cost each, an edit needs new values only until they agree with the old ones
again, and the encoding is read off backwards.

Here pieces are the matches of the pattern.  A worker sorts the pieces it hasn't met, so that each
costs only the prefixes that its neighbour hasn't, and keeps the ids of those met lately.

Cases: a null or empty text has no tokens; any text decodes to its own bytes; other columns stay.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from kinfold.llm.shared import slices, tidy

#: Bounds of a worker's tables; a full table is emptied and filled anew, results don't depend on it.
MAX_PIECES, MAX_PAIRS = 250_000, 400_000
#: Characters of text encoded at once, and of the longest piece that is kept.
TEXTS_AT_ONCE, LONG_PIECE = 2_000_000, 200


def load_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file in order of rank, which is their id."""
    with open(path, "rb") as f:
        ranked = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, f))
    if [r for r, _ in ranked] != list(range(len(ranked))):
        raise ValueError("ranks must run from 0 without gaps")
    return [t for _, t in ranked]


def merge_parts(token: bytes, ranks: dict[bytes, int], below: int) -> list[bytes]:
    """BPE of ``token`` with the merges ranked under ``below`` only."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 1:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
        if rank >= below:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> tuple[list[bytes], list[tuple[int, int] | None]]:
    """Tokens and, for each, the two tokens whose merge makes it (itself twice for one byte, None
    for a token that no encoding holds)."""
    tokens = load_ranks(path)
    ranks = {t: i for i, t in enumerate(tokens)}
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("every byte must be a token")
    splits: list[tuple[int, int] | None] = []
    for i, t in enumerate(tokens):
        parts = merge_parts(t, ranks, i)
        splits.append((i, i) if len(t) == 1 else (ranks[parts[0]], ranks[parts[1]]) if len(parts) == 2 else None)
    return tokens, splits


class PrefixEncoder:
    """The vocabulary as the tables that the prefix rule needs."""

    def __init__(self, tokens: list[bytes], splits: list[tuple[int, int] | None]):
        self.tokens, self.splits = tokens, splits
        self.lengths = [len(t) for t in tokens]
        self.ranks = {t: i for i, t in enumerate(tokens) if splits[i] is not None}
        self.merged = {s: i for i, s in enumerate(splits) if s is not None and len(tokens[i]) > 1}
        self.longest = max(self.lengths)
        self.ending: dict[int, dict] = {}  # the tokens as a trie read from their ends; -1 holds the token
        for t, i in self.ranks.items():
            node = self.ending
            for byte in reversed(t):
                node = node.setdefault(byte, {})
            node[-1] = i
        self.pairs: dict[int, bool] = {}

    def may_follow(self, left: int, right: int) -> bool:
        """Whether BPE can leave these two tokens side by side."""
        limit, tokens, splits, merged = len(self.tokens) + 1, self.tokens, self.splits, self.merged
        while True:
            if merged.get((left, right), limit) < limit:
                return False
            undo_left = len(tokens[left]) > 1 and (left > right or len(tokens[right]) == 1)
            if undo_left:
                limit, left = left, splits[left][1]
            elif len(tokens[right]) > 1:
                limit, right = right + 1, splits[right][0]
            else:
                return True

    def extend(self, data: bytes, known: list[int], end: int) -> None:
        """Appends to ``known``, where ``known[i]`` is the last token of ``data[:i]``, until it reaches
        ``data[:end]``."""
        ending, pairs = self.ending, self.pairs
        for i in range(len(known), end + 1):
            node, start, fits = ending, i, []
            while start:
                node = node.get(data[start - 1])
                if node is None:
                    break
                start -= 1
                if -1 in node:
                    fits.append((node[-1], start))
            for token, start in reversed(fits):
                if not start:
                    break
                pair = known[start] << 20 | token
                ok = pairs.get(pair)
                if ok is None:
                    if len(pairs) >= MAX_PAIRS:
                        pairs.clear()
                    ok = pairs[pair] = self.may_follow(known[start], token)
                if ok:
                    break
            known.append(token)

    def encode_pieces(self, pieces: list[bytes]) -> Iterator[tuple[int, ...]]:
        """The ids of pieces in sorted order: neighbours share the tokens of their common prefixes."""
        before, known = b"", [-1]
        for piece in pieces:
            same, most = 0, min(len(before), len(piece))
            while same < most:  # the longest common prefix, by halves
                half = (same + most + 1) // 2
                if before[same:half] == piece[same:half]:
                    same = half
                else:
                    most = half - 1
            del known[same + 1 :]
            self.extend(piece, known, len(piece))
            before = piece
            yield tuple(self.read_off(known))

    def read_off(self, last: list[int]) -> list[int]:
        out, i = [], len(last) - 1
        while i:
            out.append(last[i])
            i -= self.lengths[last[i]]
        out.reverse()
        return out


class PrefixTable:
    """The last token of every prefix of one growing, editable byte string."""

    def __init__(self, encoder: PrefixEncoder, data: bytes = b""):
        self.encoder, self.data, self.last = encoder, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.encoder.extend(self.data, self.last, len(self.data))

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Replaces ``data[start:end]``; returns how many prefixes had to be worked out again.

        Prefixes up to ``start`` keep their tokens.  Once as many tokens in a row as the longest
        token has bytes, all past the new bytes, agree with the old ones, all later ones do.
        """
        old, shift = self.last, len(new) - (end - start)
        self.data = self.data[:start] + new + self.data[end:]
        self.last = old[: start + 1]
        agreed = done = 0
        for i in range(start + 1, len(self.data) + 1):
            if agreed >= self.encoder.longest:
                self.last += old[i - shift :]
                break
            self.encoder.extend(self.data, self.last, i)
            done += 1
            agreed = agreed + 1 if i - len(new) > start and self.last[i] == old[i - shift] else 0
        return done

    def ids(self) -> list[int]:
        return self.encoder.read_off(self.last)


class Tokenizer:
    """Texts to ids and back; keeps the ids of the pieces met most lately, in two generations."""

    def __init__(self, tokens, splits, pattern: str):
        self.encoder, self.tokens = PrefixEncoder(tokens, splits), tokens
        self.numerals = [str(i) for i in range(len(tokens))]
        self.findall = regex.compile(pattern).findall
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def encode(self, texts: list[str | None]) -> Iterator[list[int]]:
        """The ids of each text, some texts at a time so that their pieces fit in memory."""
        group, size = [], 0
        for text in texts:
            group.append(text or "")
            size += len(group[-1])
            if size >= TEXTS_AT_ONCE:
                yield from self._encode(group)
                group, size = [], 0
        yield from self._encode(group)

    def _encode(self, texts: list[str]) -> Iterator[list[int]]:
        split = list(map(self.findall, texts))
        if len(self.young) >= MAX_PIECES:
            self.young, self.old = {}, self.young
        young, old, unseen, single = self.young, self.old, [], {}
        for piece in set().union(*split):
            if piece not in young:
                if piece in old:
                    young[piece] = old[piece]
                elif len(piece) <= LONG_PIECE:
                    unseen.append(piece)
                else:  # too rare to be worth keeping
                    single[piece] = tuple(PrefixTable(self.encoder, piece.encode()).ids())
        unseen.sort()  # code points sort as their UTF-8 bytes do
        young.update(zip(unseen, self.encoder.encode_pieces([p.encode() for p in unseen]), strict=True))
        for pieces in split:
            if single and not single.keys().isdisjoint(pieces):
                yield list(chain.from_iterable(young.get(p) or single[p] for p in pieces))
            else:
                yield list(chain.from_iterable(map(young.__getitem__, pieces)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def digests(self, texts: list[str | None]) -> Iterator[tuple[int, str, str]]:
        for ids in self.encode(texts):
            listed = ",".join(map(self.numerals.__getitem__, ids))
            yield len(ids), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(self.decode(ids)).hexdigest()


_here: dict[tuple, Tokenizer] = {}


def _tokenizer(shared, pattern: str) -> Tokenizer:
    """One a worker process, however many tasks it runs."""
    key = shared.id if hasattr(shared, "id") else id(shared), pattern
    if key not in _here:
        _here.clear()
        _here[key] = Tokenizer(*shared.value, pattern)
    return _here[key]


def _mapped(df: DataFrame, path: str, pattern: str, column: str, add: list[pa.Field], ddl: str, rows) -> DataFrame:
    """``df`` with the columns ``add`` in front of those of other names; ``rows(tokenizer, values)``
    gives the new columns' values."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary(path))  # a vocabulary: its size is fixed
    names = {f.name for f in add}
    kept = [c for c in df.columns if c not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(shared, pattern)
        for batch in slices(batches):
            new = rows(tokenizer, batch.column(batch.schema.get_field_index(column)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, f.type) for v, f in zip(new, add, strict=True)] + [batch.column(batch.schema.get_field_index(c)) for c in kept], [f.name for f in add] + kept
            )
        tokenizer.young, tokenizer.old = {}, {}  # the worker lives on for other tasks

    types = {f.name: f.dataType.simpleString() for f in df.schema}
    return df.mapInArrow(tidy(run), ", ".join([ddl, *(f"`{c}` {types[c]}" for c in kept)]))


def encode(df: DataFrame, path: str, pattern: str, column: str = "text", ids: str = "ids") -> DataFrame:
    """Adds ``ids``, the token ids of ``column``."""
    return _mapped(df, path, pattern, column, [pa.field(ids, pa.list_(pa.int32()))], f"`{ids}` array<int>", lambda t, values: [list(t.encode(values.to_pylist()))])


def decode(df: DataFrame, path: str, pattern: str, column: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds ``decoded``, the bytes that the ids in ``column`` stand for."""
    return _mapped(df, path, pattern, column, [pa.field(decoded, pa.binary())], f"`{decoded}` binary", lambda t, values: [[t.decode(v.as_py() or []) for v in values]])


def digests(df: DataFrame, path: str, pattern: str, column: str = "text") -> DataFrame:
    """Adds n_tokens, ids_sha256 and decoded_sha256: the ids and the round trip, as digests, so that
    the ids themselves needn't leave the worker."""
    add = [pa.field("n_tokens", pa.int64()), pa.field("ids_sha256", pa.string()), pa.field("decoded_sha256", pa.string())]

    def rows(tokenizer: Tokenizer, values):
        found = list(tokenizer.digests(values.to_pylist()))
        return [list(x) for x in zip(*found, strict=True)] if found else [[], [], []]

    return _mapped(df, path, pattern, column, add, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", rows)


def op3_prefix_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
