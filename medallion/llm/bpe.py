"""Byte-level BPE encoding and decoding.

Encoding. The ranks are compiled into a finite-state transducer over bytes. Two neighbouring tokens are stable when
the merges of their joined bytes give these two tokens again, and a token sequence is the encoding of its bytes
exactly when all its neighbours are stable. So the transducer guesses where tokens end, by a trie of all tokens, and
checks each guess against the token before. It is made deterministic lazily, state by state, as texts need it: a
state is the set of guesses that are still open, each with the tokens it would emit, and the tokens that all guesses
share are emitted. A guess ends at the latest where no longer token exists, so the lookahead is bounded by the
longest token.

Decoding is streaming: ids are turned into bytes part by part, and a UTF-8 state machine holds back the bytes of a
character that isn't complete yet.

Defined results
* A NULL text is empty and has no ids. Special tokens are ordinary text.
* Ids that aren't valid UTF-8 together decode with U+FFFD in place of the invalid bytes; unknown ids fail.
* Rows keep their other columns out of sight: only the id and the text are read.
"""

from __future__ import annotations

import base64
import gc
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.llm.chunks import ID_BYTES, MatchIds, slices
from medallion.llm.common import whole_text, worker_cache

_AT_ONCE = 250
_BYTES_AT_ONCE = 65_536

Guess = tuple[int, int, tuple[int, ...]]  # the token before, the place in the trie, the tokens to emit


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Transducer:
    """Bytes to token ids, one state and byte after the other. ``most`` bounds the states that are kept."""

    ROOT, NONE = 0, -1

    def __init__(self, ranks: dict[bytes, int], most: int = 150_000) -> None:
        self.ranks, self.most = ranks, most
        self.tokens = {rank: token for token, rank in ranks.items()}
        # A place in the trie has, for each next byte, the place behind it, whether tokens go on from there, and the
        # token that ends there.
        below: list[dict[int, int]] = [{}]
        ends: list[int] = [self.NONE]
        for token, rank in ranks.items():
            at = self.ROOT
            for byte in token:
                place = below[at].setdefault(byte, len(below))
                if place == len(below):
                    below.append({})
                    ends.append(self.NONE)
                at = place
            ends[at] = rank
        self.places = [{byte: (at, bool(below[at]), ends[at]) for byte, at in part.items()} for part in below]
        self.pairs: dict[int, bool] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[tuple[Guess, ...], int] = {}
        self.states: list[tuple[Guess, ...]] = []
        self.moves: list[dict[int, tuple[int, tuple[int, ...]]]] = []
        self.ends: list[tuple[int, ...]] = []
        self.pairs.clear()
        self.number(((self.NONE, self.ROOT, ()),))

    def merged(self, data: bytes) -> list[int]:
        """The merges by their definition: the pair of the lowest rank first, the leftmost of equals."""
        parts = [data[k : k + 1] for k in range(len(data))]
        while len(parts) > 1:
            found = [(self.ranks.get(a + b, len(self.ranks)), k) for k, (a, b) in enumerate(zip(parts, parts[1:]))]
            rank, k = min(found)
            if rank == len(self.ranks):
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return [self.ranks[part] for part in parts]

    def made_of(self, token: int) -> tuple[int, int]:
        """The two tokens whose merge made this one; a single byte has none."""
        data, ranks = self.tokens[token], self.ranks
        cuts = [(ranks[data[:k]], ranks[data[k:]]) for k in range(1, len(data)) if data[:k] in ranks and data[k:] in ranks]
        if len(cuts) > 1:
            cuts = [cut for cut in cuts if self.apart(*cut, 2 * token)]
        return cuts[0] if cuts else (self.NONE, self.NONE)

    def apart(self, left: int, right: int, limit: int) -> bool:
        """Whether two tokens are still apart when the merges before ``limit`` are done on their joined bytes.

        Merges are undone backwards, the latest first, to see what stood on both sides of the seam at each time.
        The tokens merge across it if that merge has a lower rank than the next one on either side, or the same
        rank and stands to the left of it.
        """
        tokens, ranks, halves = self.tokens, self.ranks, self.halves
        while True:
            joined = ranks.get(tokens[left] + tokens[right])
            if joined is not None and 2 * joined < limit:
                return False
            left_made = halves.get(left)
            if left_made is None:
                left_made = halves[left] = self.made_of(left)
            right_made = halves.get(right)
            if right_made is None:
                right_made = halves[right] = self.made_of(right)
            if left_made[0] < 0 and right_made[0] < 0:
                return True
            if right_made[0] < 0 or left_made[0] >= 0 and left > right:
                limit, left = 2 * left, left_made[1]
            else:
                limit, right = 2 * right + 1, right_made[0]

    def stable(self, before: int, token: int) -> bool:
        """Whether two tokens stay apart when their bytes are encoded together."""
        found = before == self.NONE or self.apart(before, token, 2 * len(self.ranks))
        self.pairs[before << 32 | token] = found
        return found

    def number(self, guesses: tuple[Guess, ...]) -> int:
        known = self.numbers.get(guesses)
        if known is None:
            known = self.numbers[guesses] = len(self.states)
            self.states.append(guesses)
            self.moves.append({})
            self.ends.append(guesses[-1][2] if guesses[-1][1] == self.ROOT else ())
        return known

    def move(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The state behind a byte and the tokens that are settled by it; made once, when first needed.

        Guesses are kept in the order of the place where their token begins. At most one token can end here, as the
        encoding of what has been read is unique.
        """
        guesses: list[Guess] = []
        ended: Guess | None = None
        places, pairs = self.places, self.pairs
        for before, at, out in self.states[state]:
            place = places[at].get(byte)
            if place is None:
                continue
            below, goes_on, token = place
            if goes_on:
                guesses.append((before, below, out))
            if token >= 0 and ended is None:
                stable = pairs.get(before << 32 | token)
                if self.stable(before, token) if stable is None else stable:
                    ended = (token, self.ROOT, (*out, token))
        if ended is not None:
            guesses.append(ended)
        emitted: tuple[int, ...] = ()
        first = guesses[0][2]
        if first:
            settled, shortest = 0, min([len(out) for _, _, out in guesses])
            while settled < shortest and all([out[settled] == first[settled] for _, _, out in guesses]):
                settled += 1
            if settled:
                emitted = first[:settled]
                guesses = [(before, at, out[settled:]) for before, at, out in guesses]
        step = self.number(tuple(guesses)), emitted
        self.moves[state][byte] = step
        return step

    def encode(self, data: bytes) -> list[int]:
        if len(self.states) > self.most:
            self.forget()
        state, ids, moves = 0, [], self.moves
        for byte in data:
            step = moves[state].get(byte)
            if step is None:
                step = self.move(state, byte)
            state, emitted = step
            if emitted:
                ids += emitted
        ids += self.ends[state]
        return ids


def text_encoder(path: str, pattern: str) -> MatchIds:
    """Each match of the pattern goes through the transducer by itself."""
    import regex

    return MatchIds(regex.compile(pattern).findall, Transducer(read_ranks(path)).encode)


class Utf8Stream:
    """Bytes in, text out; a character that is not complete waits for the next bytes."""

    def __init__(self) -> None:
        self.waiting = b""

    @staticmethod
    def unfinished(data: bytes) -> int:
        """How many bytes at the end begin a character without ending it."""
        for n in range(1, min(3, len(data)) + 1):
            lead = data[-n]
            if 0x80 <= lead < 0xC0:
                continue
            length = 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 1
            if length <= n:
                return 0
            if n > 1:  # a few leads allow fewer second bytes, so that each character has one form
                low, high = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(lead, (0x80, 0xBF))
                if not low <= data[1 - n] <= high:
                    return 0
            return n
        return 0

    def feed(self, data: bytes) -> str:
        data = self.waiting + data
        cut = len(data) - self.unfinished(data)
        self.waiting = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self.waiting = self.waiting, b""
        return rest.decode("utf-8", "replace")


def token_bytes(path: str) -> pa.Array:
    """The bytes of every token, by its id."""
    ranks = read_ranks(path)
    tokens: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return pa.array(tokens, pa.large_binary())


def np_offsets(values: pa.Array):
    import numpy as np

    return np.frombuffer(values.buffers()[1], "<i8")[values.offset : values.offset + len(values) + 1] if len(values) else [0]


def decoded(data: bytes, at_once: int = _BYTES_AT_ONCE) -> str:
    """Text from the bytes of tokens, part by part."""
    stream = Utf8Stream()
    parts = [stream.feed(data[at : at + n]) for at, n in slices(len(data), at_once)]
    return "".join([*parts, stream.finish()])


def encode_texts(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id and ids (array of int) of every text, whole."""
    rows = docs.select(F.col("doc_id"), whole_text().alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        gc.disable()  # hundreds of thousands of states, and no cycle among them
        try:
            matches = worker_cache(f"bpe:{ranks}:{pattern}", lambda: text_encoder(ranks, pattern))
            for batch in batches:
                for at, n in slices(batch.num_rows, _AT_ONCE):
                    part = batch.slice(at, n)
                    found = matches.ids(part.column(1).to_pylist())
                    ends = np.cumsum([0, *map(len, found)]) // ID_BYTES
                    values = pa.array(np.frombuffer(b"".join(found), "<u4").astype("i4"))
                    ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                    yield pa.RecordBatch.from_arrays([part.column(0), ids], names=schema.names)
        finally:
            gc.enable()

    return rows.mapInArrow(encode, schema)


def decode_ids(encoded: DataFrame, ranks: str) -> DataFrame:
    """The rows of ``encoded`` (doc_id, ids) with the text that the ids stand for."""
    rows = encoded.select("doc_id", "ids")
    schema = T.StructType([*rows.schema.fields, T.StructField("text", T.StringType())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = worker_cache(f"tokens:{ranks}", lambda: token_bytes(ranks))
        for batch in batches:
            for at, n in slices(batch.num_rows, _AT_ONCE):
                part = batch.slice(at, n)
                ids, texts = part.column(1), []
                said = tokens.take(ids.flatten())  # the bytes of all texts of the part, one behind the other
                if said.null_count:
                    raise ValueError("an id has no token")
                ends = np_offsets(said)
                data, first = memoryview(said.buffers()[2] or b""), 0
                for length, valid in zip(pc.list_value_length(ids).to_pylist(), ids.is_valid().to_pylist(), strict=True):
                    last = first + (length or 0)
                    texts.append(decoded(bytes(data[ends[first] : ends[last]])) if valid else None)
                    first = last
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=schema.names)

    return rows.mapInArrow(decode, schema)


def round_trip(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text."""
    encoded = encode_texts(docs, ranks, pattern)
    return decode_ids(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
