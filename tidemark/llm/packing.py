"""Best-fit packing of token sequences by minimum bin slack.

Tokenizing is one pass over the texts in Arrow batches. Packing looks at lengths
only: their histogram has at most ``capacity`` entries however many documents
there are, so the bins are decided there, as patterns with a number of
repetitions, and the pieces are then dealt to the bins by their rank within
their length. No bin is ever gathered.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import python_ready, ranked, stored, text_of

CAPACITY = 1024
END = 2
# Words a Python worker remembers the ids of, in each of two generations.
REMEMBERED = 450_000

# White space that texts are not cut at; such texts are encoded in one piece.
_OTHER_SPACE = ("\t", "\r", "\x0b", "\x0c", "\x85", "\xa0", "  ", "\n\n", " \n", "\n ")
_WIDE_SPACE = re.compile("[\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")
# Letters up to here have been letters in every edition of Unicode.
_OLD_LETTERS = "\u0250"

_loaded: dict[str, WordEncoder] = {}


class Remembered(dict):
    """Values by key, computed when first asked for. When a generation is full the
    one before it is dropped; a key that is still in use moves to the new one."""

    def __init__(self, compute: Callable[[str], bytes], most: int = REMEMBERED) -> None:
        self.compute, self.most, self.old = compute, most, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class WordEncoder:
    """Ids of whole texts, by words.

    Byte-level BPE never merges across the start of white space, so the ids of a
    text are those of its words, each with the blank before it, and of its line
    ends. Texts repeat words, and a worker remembers the ids of those it has seen.
    Texts with other or repeated white space are encoded in one piece.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings are text here
        self.model, self.split = self.tokenizer.model, ByteLevel(add_prefix_space=False)
        spelled = sorted(ByteLevel.alphabet())
        plain = [c for c in spelled if ord(c) < 256]
        shifted = iter(c for c in spelled if ord(c) >= 256)
        self.spelling = {b: chr(b) if chr(b) in plain else next(shifted) for b in range(256)}
        self.packed = [array("I", [i]).tobytes() for i in range(max(self.tokenizer.get_vocab().values()) + 1)]
        self.blank = self.spelling[ord(" ")]
        self.tokens = Remembered(self._token)
        self.words = Remembered(self._after_blank)
        self.starts = Remembered(lambda word: self._word("", word))
        self.line_end = self._word("", "\n")

    def _token(self, spelled: str) -> bytes:
        return b"".join([self.packed[t.id] for t in self.model.tokenize(spelled)])

    def _after_blank(self, word: str) -> bytes:
        if word.isascii():
            # Most words that were not seen before: letters, and the marks after them.
            if word.isalpha():
                return self._token(self.blank + word)
            letters = word.rstrip(".,!?")
            if letters.isalpha():
                return self.words[letters] + self.tokens[word[len(letters) :]]
        return self._word(" ", word)

    def _word(self, blank: str, word: str) -> bytes:
        letters = word.rstrip(".,!?")
        if letters.isalpha() and max(letters) < _OLD_LETTERS:
            # The splitter's usual case.
            marks = word[len(letters) :]
            head = self._token((blank + letters).encode().decode("latin-1").translate(self.spelling))
            return head + self.tokens[marks] if marks else head
        return b"".join([self.tokens[p] for p, _ in self.split.pre_tokenize_str(blank + word)])

    def narrow(self, ids: bytes) -> bytes:
        """32-bit ids in 16 bits, where all of the tokenizer's fit."""
        if self.tokenizer.get_vocab_size() > 1 << 16:
            return ids
        return array("H", array("I", ids)).tobytes()

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if (
            any(s in text for s in _OTHER_SPACE)
            or text[:1] in (" ", "\n")
            or text[-1:] in (" ", "\n")
            or (not text.isascii() and _WIDE_SPACE.search(text))
        ):
            found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
            return array("I", found[0].ids).tobytes()
        out, word = [], self.words.__getitem__
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            out.append(self.starts[first])
            out += map(word, rest)
            out.append(self.line_end)
        return b"".join(out[:-1])


def _encoder(path: str) -> WordEncoder:
    if path not in _loaded:
        _loaded[path] = WordEncoder(path)
    return _loaded[path]


def cut(count: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``count`` ids: whole ones at the end, and
    what is left over, if anything, first."""
    first = count % capacity
    out = [(0, first)] if first else []
    return out + [(at, capacity) for at in range(first, count, capacity)]


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end: int = END,
    with_ids: bool = False,
    keep: Sequence[str] = (),
    narrow: bool = False,
) -> DataFrame:
    """Tokenize whole texts, end each with the id ``end`` and cut those longer than
    ``capacity``. One row per piece: doc_id, piece, start, length, ids_crc32, with
    ``with_ids`` the ids themselves as little-endian numbers of 32 bits (with
    ``narrow`` of 16 if the tokenizer has no larger ones), and the columns ``keep``.

    A null or empty text is one piece that holds ``end`` only. Repeated rows give
    repeated pieces, a null doc_id stays null, other columns are left aside.
    """
    python_ready(docs.sparkSession)
    fields = [
        T.StructField("doc_id", docs.schema["doc_id"].dataType),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    fields += [docs.schema[c] for c in keep]
    last = end.to_bytes(4, "little")

    def pieces(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encoder = _encoder(tokenizer)
        for batch in batches:
            rows: list[tuple] = []
            for at, text in enumerate(batch.column("text").to_pylist()):
                ids = encoder.encode(text) + last
                for n, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + length)]
                    kept = encoder.narrow(own) if narrow and with_ids else own
                    rows.append((at, n, start, length, zlib.crc32(own), kept))
            at, n, start, length, crc, own = zip(*rows, strict=True) if rows else [()] * 6
            rows_at = pa.array(at, pa.int64())
            columns = {
                "doc_id": batch.column("doc_id").take(rows_at),
                "piece": pa.array(n, pa.int32()),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array(own, pa.binary())
            columns |= {c: batch.column(c).take(rows_at) for c in keep}
            yield pa.RecordBatch.from_pydict(columns)

    texts = docs.select(docs["doc_id"].alias("doc_id"), text_of(docs).alias("text"), *[docs[c] for c in keep])
    return texts.mapInArrow(pieces, T.StructType(fields))


def fullest(counts: list[int], room: int) -> dict[int, int]:
    """The combination of available lengths that fills ``room`` as far as any can.

    Subset sums as bits of one integer: adding an item shifts it. Copies of a
    length go in as packs of 1, 2, 4, ... so that every number of them can be
    reached. Longest first; it ends as soon as the room can be filled whole.
    """
    sums, everything, steps = 1, (1 << (room + 1)) - 1, []
    for length in range(min(room, len(counts) - 1), 0, -1):
        left, pack = min(counts[length], room // length), 1
        while left:
            taken = min(pack, left)
            steps.append((length, taken, sums))
            sums |= (sums << (length * taken)) & everything
            left, pack = left - taken, pack * 2
        if sums >> room:
            break
    reached, chosen = sums.bit_length() - 1, {}
    for length, taken, before in reversed(steps):
        if not before >> reached & 1:
            chosen[length] = chosen.get(length, 0) + taken
            reached -= length * taken
    return chosen


def bin_patterns(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Fill bins by minimum bin slack: each starts with the longest piece left and
    takes the fullest combination that still fits. A combination stays the fullest
    one as long as its lengths last, since taking items away opens no new sum; so
    it is repeated at once, and the list is short however many pieces there are."""
    counts = [0] * (capacity + 1)
    for length, n in histogram.items():
        counts[length] += n
    patterns, longest = [], capacity
    while True:
        while longest and not counts[longest]:
            longest -= 1
        if not longest:
            return patterns
        counts[longest] -= 1
        chosen = fullest(counts, capacity - longest)
        counts[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(counts[length] // n for length, n in chosen.items())
        for length, n in chosen.items():
            counts[length] -= n * times
        patterns.append((chosen, times))


def placements(patterns: list[tuple[dict[int, int], int]]) -> list[tuple]:
    """For each length of each pattern: the ranks it takes, and where they go. Row:
    (length, first rank, rank after the last, pieces per bin, first bin, offset)."""
    out, used, bins = [], {}, 0
    for chosen, times in patterns:
        offset = 0
        for length in sorted(chosen, reverse=True):
            n, first = chosen[length], used.get(length, 0)
            out.append((length, first, first + n * times, n, bins, offset))
            used[length] = first + n * times
            offset += n * length
        bins += times
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Put pieces (column ``length``, 1 to ``capacity``) into as few sequences as
    minimum bin slack finds; adds sequence_id and offset.

    ``pieces`` is read several times, so it should be stored. An empty table stays
    empty; equal pieces are interchangeable. The table of places has at most about
    45 rows per pattern and a few patterns per length, which bounds the broadcast
    by ``capacity`` alone.
    """
    spark = pieces.sparkSession
    counted = pieces.groupBy("length").count().collect()  # at most ``capacity`` rows
    patterns = bin_patterns({r["length"]: r["count"] for r in counted}, capacity)
    names = ["p_length", "p_first", "p_after", "p_each", "p_bin", "p_offset"]
    schema = T.StructType([T.StructField(n, T.LongType()) for n in names])
    places = spark.createDataFrame(placements(patterns), schema)
    keys = [c for c in ("doc_id", "piece", "start", "ids_crc32", "row") if c in pieces.columns]
    numbered = ranked(pieces, ["length"], F.xxhash64(*keys), keys, "p_rank")
    rank = F.col("p_rank")
    placed = numbered.join(
        F.broadcast(places),
        (F.col("length") == F.col("p_length"))
        & (rank >= F.col("p_first"))
        & (rank < F.col("p_after")),
    )
    nth = rank - F.col("p_first")
    return placed.select(
        *pieces.columns,
        (F.col("p_bin") + F.floor(nth / F.col("p_each"))).cast("long").alias("sequence_id"),
        (F.col("p_offset") + nth % F.col("p_each") * F.col("length")).alias("offset"),
    )


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """Tokenize, cut and pack whole documents; see the two steps.

    With ``with_ids`` the sequences can be read from the rows: ``ids`` holds a
    piece's ids, narrow where they can be, and ``copy`` numbers the rows of a doc_id from 0, so that doc_id,
    copy and piece tell each piece. Ids are shuffled once, to their places.
    """
    if not with_ids:
        return pack(stored(token_pieces(docs, tokenizer, capacity)), capacity)
    rows = docs.select(
        docs["doc_id"].alias("doc_id"),
        text_of(docs).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    pieces = stored(token_pieces(rows, tokenizer, capacity, with_ids=True, keep=["row"], narrow=True))
    # A struct, as a null doc_id has copies too.
    firsts = pieces.where("piece = 0").select(F.struct("doc_id").alias("doc"), "ids_crc32", "row")
    copies = ranked(firsts, ["doc"], F.xxhash64("row"), ["ids_crc32", "row"], "copy")
    placed = pack(pieces.drop("ids"), capacity).join(copies.select("row", "copy"), "row")
    whole = placed.join(pieces.select("row", "piece", "ids"), ["row", "piece"])
    names = ["piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids"]
    return whole.select("doc_id", "copy", *names)
