"""Byte-level BPE as a lazily determinised finite-state transducer, and a streaming decoder.

A sequence of tokens is the BPE encoding of its bytes exactly if each token merges to itself and
each pair of neighbours, merged on its own, stays that pair. So the encodings form the paths of a
finite automaton: a configuration is (last token, bytes of the next one so far), reading a byte
either goes on with the token or closes it, if the pair of tokens is stable. Subsets of
configurations are the states of the transducer; they are made when first reached and remembered,
with each transition saying which configuration follows which, and the token it closes. Tokens
that all configurations of a state share leave once the next bytes have ruled out the rest; the
lookahead is bounded by the token lengths, not by the text.

Texts are first split by the vocabulary's pattern; each match is encoded separately. All tables
of a task are bounded: past their limit they are dropped and built anew.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerline.llm.common import TwoAges, per_worker

#: States, stable pairs and whole matches that a task remembers.
STATE_LIMIT = 250_000
PAIR_LIMIT = 500_000
WORD_LIMIT = 600_000
WORD_BYTES = 64
#: Open characters whose steps a decoder remembers.
OPEN_LIMIT = 500
#: Bytes of a long match after which shared output leaves.
LOOKAHEAD = 128
#: Documents whose token ids are held at once on the way out.
ROWS_OUT = 500


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, file)}


class Transducer:
    """Bytes of one pattern match to token ids."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self._ranks = ranks
        self._bytes = {rank: token for token, rank in ranks.items()}
        # The tokens as a trie: node << 8 | byte to node, and the token that ends at a node.
        self._child: dict[int, int] = {}
        self._ends = [-1]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                edge = node << 8 | byte
                node = self._child.get(edge, 0)
                if not node:
                    node = self._child[edge] = len(self._ends)
                    self._ends.append(-1)
            self._ends[node] = rank
        self._inner = {edge >> 8 for edge in self._child}
        self._pairs: dict[tuple[int, int], bool] = {}
        self._reset()

    def _reset(self) -> None:
        start = ((-1, 0),)
        self._states = [start]
        self._numbers = {start: 0}
        self._steps: dict[int, tuple[int, tuple[tuple[int, int], ...]]] = {}

    def merged(self, data: bytes, border: int = 0) -> list[int] | None:
        """The definition: merge the leftmost pair of least rank until there is none.

        None as soon as a merge spans the border (bytes before it; 0: there is none).
        """
        ranks = self._ranks
        none = len(ranks)
        parts = [data[i : i + 1] for i in range(len(data))]
        costs = [ranks.get(data[i : i + 2], none) for i in range(len(data) - 1)]
        before = border  # parts on the left of the border
        while costs:
            cost = min(costs)
            if cost == none:
                break
            at = costs.index(cost)
            if at < before:
                before -= 1
                if at == before:
                    return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del costs[at]
            if at:
                costs[at - 1] = ranks.get(parts[at - 1] + parts[at], none)
            if at < len(costs):
                costs[at] = ranks.get(parts[at] + parts[at + 1], none)
        return [ranks[p] for p in parts]

    def _stable(self, left: int, right: int) -> bool:
        """Do the two tokens (the first may be missing, -1) stay as they are side by side?"""
        known = self._pairs.get((left, right))
        if known is None:
            if len(self._pairs) >= PAIR_LIMIT:
                self._pairs.clear()
            before = self._bytes.get(left, b"")
            merged = self.merged(before + self._bytes[right], len(before))
            known = merged == ([right] if left < 0 else [left, right])
            self._pairs[left, right] = known
        return known

    def _step(self, state: int, byte: int) -> tuple[int, tuple[tuple[int, int], ...]]:
        """The next state, and for each of its configurations the one it comes from and the
        token closed on the way (-1: none)."""
        reached = {}
        for source, (last, node) in enumerate(self._states[state]):
            grown = self._child.get(node << 8 | byte)
            if grown is None:
                continue
            if grown in self._inner:
                reached[last, grown] = (source, -1)
            token = self._ends[grown]
            if token >= 0 and self._stable(-1, token) and self._stable(last, token):
                reached[token, 0] = (source, token)
        subset = tuple(sorted(reached))
        number = self._numbers.get(subset)
        if number is None:
            number = self._numbers[subset] = len(self._states)
            self._states.append(subset)
        out = (number, tuple([reached[c] for c in subset]))
        self._steps[state << 8 | byte] = out
        return out

    def encode(self, data: bytes) -> list[int]:
        whole = self._ranks.get(data)
        if whole is not None:  # a match that is a token is that token, whatever its merges
            return [whole]
        if len(self._states) > STATE_LIMIT:
            self._reset()
        ids: list[int] = []
        state, steps = 0, self._steps
        held: list = [None]  # for each configuration its undecided tokens, newest first
        for at, byte in enumerate(data, 1):
            step = steps.get(state << 8 | byte) or self._step(state, byte)
            state = step[0]
            held = [(held[i], token) if token >= 0 else held[i] for i, token in step[1]]
            if not at % LOOKAHEAD:
                ids += self._settle(held)
                if len(self._states) > 2 * STATE_LIMIT:
                    here = self._states[state]
                    self._reset()
                    steps, state = self._steps, self._numbers.setdefault(here, 1)
                    if state:
                        self._states.append(here)
        # Exactly one configuration ends with the data.
        rest = held[next(i for i, (_, node) in enumerate(self._states[state]) if not node)]
        return ids + _unwound(rest)

    @staticmethod
    def _settle(held: list) -> list[int]:
        """Emit what all configurations share; keep the rest."""
        rows = [_unwound(h) for h in held]
        sure = 0
        while all(len(r) > sure and r[sure] == rows[0][sure] for r in rows):
            sure += 1
        for i, row in enumerate(rows):
            chain = None
            for token in row[sure:]:
                chain = (chain, token)
            held[i] = chain
        return rows[0][:sure]


def _unwound(chain: tuple | None) -> list[int]:
    out = []
    while chain is not None:
        chain, token = chain
        out.append(token)
    out.reverse()
    return out


class Encoder:
    """Whole texts to ids, packed as little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import regex

        self._split = regex.compile(pattern).findall
        self._machine = Transducer(ranks)
        self._known = TwoAges(WORD_LIMIT)

    def _encode(self, match: str) -> bytes:
        ids = self._known.older(match)
        if ids is None:
            data = match.encode("utf-8")
            ids = b"".join([i.to_bytes(4, "little") for i in self._machine.encode(data)])
            if len(data) > WORD_BYTES:
                return ids
        self._known.add(match, ids)
        return ids

    def encode(self, text: str) -> bytes:
        matches = self._split(text)
        parts = list(map(self._known.young.get, matches))
        if None in parts:
            encode = self._encode
            parts = [encode(m) if p is None else p for p, m in zip(parts, matches)]
        return b"".join(parts)


class Utf8Stream:
    """Text of a stream of byte tokens: an incremental UTF-8 state machine.

    Its state is the bytes of a character that is still open (at most three), so what has been
    read is either text already or one of few states; steps by whole tokens are remembered.
    Bytes that cannot be part of UTF-8 become U+FFFD, one for each such byte.
    """

    def __init__(self, tokens: dict[int, bytes]) -> None:
        self._tokens = tokens
        self._steps: dict[bytes, dict[int, tuple[bytes, str]]] = {}
        self._open = b""

    @staticmethod
    def _room(lead: int) -> tuple[int, int, int]:
        """Bytes of a character by its first one, and the range of the second; 0: no first byte."""
        if lead < 0x80:
            return 1, 0, 0
        if 0xC2 <= lead <= 0xDF:
            return 2, 0x80, 0xBF
        if 0xE0 <= lead <= 0xEF:
            return 3, 0xA0 if lead == 0xE0 else 0x80, 0x9F if lead == 0xED else 0xBF
        if 0xF0 <= lead <= 0xF4:
            return 4, 0x90 if lead == 0xF0 else 0x80, 0x8F if lead == 0xF4 else 0xBF
        return 0, 0, 0

    def _advance(self, state: bytes, data: bytes) -> tuple[bytes, str]:
        text, held = [], state
        for byte in data:
            if held:
                size, low, high = self._room(held[0])
                if (low <= byte <= high) if len(held) == 1 else 0x80 <= byte <= 0xBF:
                    held += bytes((byte,))
                    if len(held) == size:
                        text.append(held.decode("utf-8"))
                        held = b""
                    continue
                text.append("�" * len(held))
                held = b""
            size = self._room(byte)[0]
            if size == 1:
                text.append(chr(byte))
            elif size:
                held = bytes((byte,))
            else:
                text.append("�")
        return held, "".join(text)

    def feed(self, ids: Iterable[int]) -> str:
        """The text that is certain after these tokens."""
        steps, state, text = self._steps, self._open, []
        for token in ids:
            own = steps.get(state)
            if own is None:
                own = steps[state] = {}
            step = own.get(token)
            if step is None:
                if len(steps) >= OPEN_LIMIT:
                    steps.clear()
                    own = steps[state] = {}
                step = own[token] = self._advance(state, self._tokens[token])
            state = step[0]
            text.append(step[1])
        self._open = state
        return "".join(text)

    def close(self) -> str:
        """An unfinished character at the end."""
        rest, self._open = "�" * len(self._open), b""
        return rest


def _encoder(path: str, pattern: str) -> Encoder:
    return per_worker(("encoder", path, pattern), lambda: Encoder(read_ranks(path), pattern))


def _decoder(path: str) -> Utf8Stream:
    return per_worker(
        ("decoder", path), lambda: Utf8Stream({rank: token for token, rank in read_ranks(path).items()})
    )


def encode(
    documents: DataFrame, ranks_path: str, pattern: str, *, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """key, ids (array of int) of each whole text.

    A null text counts as empty and has no ids; null keys and equal rows stay as they are;
    other columns are ignored.
    """
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"`{key}` {rows.schema['key'].dataType.simpleString()}, ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        encoder = _encoder(ranks_path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(at, ROWS_OUT)
                ids = [np.frombuffer(encoder.encode(t.as_py() or ""), "<i4") for t in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.list_(pa.int32()))], [key, "ids"]
                )

    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks_path: str, *, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key, text, text_sha256 (of its UTF-8 bytes) of each row of ids; null ids count as none."""
    rows = encoded.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    schema = f"`{key}` {rows.schema['key'].dataType.simpleString()}, text string, text_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = _decoder(ranks_path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(at, ROWS_OUT)
                texts = [stream.feed(i.as_py() or ()) + stream.close() for i in part.column(1)]
                digests = [hashlib.sha256(t.encode("utf-8")).hexdigest() for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(texts, pa.string()), pa.array(digests)],
                    [key, "text", "text_sha256"],
                )

    return rows.mapInArrow(run, schema)


def digests(
    documents: DataFrame, ranks_path: str, pattern: str, *, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Round trip of each text in one task: key, n_tokens, ids_sha256, decoded_sha256.

    The same encoder and decoder as in ``encode`` and ``decode``, without the ids between them
    leaving the task. Nulls, empty texts and equal rows as there.
    """
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = (
        f"`{key}` {rows.schema['key'].dataType.simpleString()}, n_tokens long, ids_sha256 string, "
        "decoded_sha256 string"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        encoder, stream = _encoder(ranks_path, pattern), _decoder(ranks_path)
        for batch in batches:
            counts, firsts, seconds = [], [], []
            for body in batch.column(1):
                ids = encoder.encode(body.as_py() or "")
                counts.append(len(ids) >> 2)
                firsts.append(hashlib.sha256(ids).hexdigest())
                digest = hashlib.sha256()
                digest.update(stream.feed(np.frombuffer(ids, "<u4").tolist()).encode("utf-8"))
                digest.update(stream.close().encode("utf-8"))
                seconds.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(firsts), pa.array(seconds)],
                [key, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return rows.mapInArrow(run, schema)
