"""Packing documents into sequences of a fixed length, shortest pack first.

1. Every document is tokenised once; its ids are stored. What exceeds whole
   sequences is one piece; whole stretches of ``max_tokens`` ids are sequences
   of their own.
2. The histogram of piece lengths (at most ``max_tokens`` entries, whatever the
   corpus) is packed on the driver: lengths longest first, each into the packs
   with the most room, new packs where none has room. Packs with the same
   lengths are one pattern with a count.
3. Packs with room left are made whole: the emptiest are taken apart and cut to
   fill the fullest. What remains, less than one sequence, is cut into powers of
   two, which need no padding. Packs that lack at most ``slack`` ids stay as
   they are, so padding is below ``slack / max_tokens``.
4. A piece has a rank among the pieces of its length: its place in its task, and
   the sum of the tasks before. The rank names pattern, sequence and offset.
   A length that a third of all documents share is ranked by tasks like any other.

Defined cases: a null text is empty and has the end id alone; an empty table
gives no rows; a document of any length is cut, never dropped; rows equal in
every column are packed one by one; a null ``doc_id`` is kept; other columns are
ignored. Strings of special tokens in a text are ordinary text unless
``specials`` is set. A text without white space is encoded whole.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from struct import pack as pack_ids

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import by_shuffle, save, steps

ID = np.dtype("<u4")
# Encoded words kept by a task (the last so many, and as many before), and the longest kept, in bytes.
KEPT_WORDS, KEPT_BYTES = 400_000, 64
# Text encoded at once, in bytes.
ENCODE_BYTES = 1 << 20
# Text whose words are looked up at once, in bytes, and words of letters encoded as one line.
WORDS_BYTES, LINE_WORDS = 16 << 20, 1000
# Sequence ids of whole stretches begin here: task number times SPAN on top.
SPAN = 1 << 36


@dataclass
class Pattern:
    """Packs alike: (length, copies) in order, their sum, how many, and the id of the first."""

    lengths: list[tuple[int, int]]
    used: int
    count: int
    first: int = 0


@dataclass
class Plan:
    """Where the pieces of every length go. ``kept`` and ``filled`` packs are
    sequences, those of ``donors`` are laid end to end and cut: first into the
    room of ``filled``, the rest into ``tail``."""

    max_tokens: int
    kept: list[Pattern] = field(default_factory=list)
    filled: list[Pattern] = field(default_factory=list)
    donors: list[Pattern] = field(default_factory=list)
    tail: list[int] = field(default_factory=list)


# --- the histogram ---------------------------------------------------------------


def shortest_pack_first(histogram: dict[int, int], max_tokens: int) -> list[Pattern]:
    """Patterns for ``{length: pieces}``: longest lengths first, each into the packs with the most room."""
    # a pack's lengths are a linked list (earlier, length, copies), shared between packs that were one
    heap: list[tuple[int, int, tuple | None, int]] = []
    serial = 0

    def put(room: int, chain: tuple | None, count: int) -> None:
        nonlocal serial
        if count:
            serial += 1
            heapq.heappush(heap, (-room, serial, chain, count))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not heap or -heap[0][0] < length:
                each = max_tokens // length
                put(max_tokens - each * length, (None, length, each), left // each)
                rest = left % each
                if rest:
                    put(max_tokens - rest * length, (None, length, rest), 1)
                break
            room, _, chain, count = heapq.heappop(heap)
            room = -room
            if left < count:
                put(room - length, (chain, length, 1), left)
                put(room, chain, count - left)
                break
            # one after the other until another pack has more room
            other = -heap[0][0] if heap else 0
            copies = max(1, min(left // count, room // length, (room - other) // length + 1))
            put(room - copies * length, (chain, length, copies), count)
            left -= copies * count
    found: dict[tuple, Pattern] = {}
    for room, _, chain, count in sorted(heap, key=lambda x: x[:2]):
        lengths = []
        while chain:
            chain, length, copies = chain
            lengths.append((length, copies))
        merged: dict[int, int] = {}
        for length, copies in reversed(lengths):
            merged[length] = merged.get(length, 0) + copies
        key = tuple(merged.items())
        if key in found:
            found[key].count += count
        else:
            found[key] = Pattern(list(key), max_tokens + room, count)
    return list(found.values())


def powers_of_two(n: int) -> list[int]:
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def plan_packs(histogram: dict[int, int], max_tokens: int = 4096, slack: int = 4) -> Plan:
    """Patterns of the histogram, made whole by cutting the emptiest packs."""
    plan, open_ = Plan(max_tokens), []
    for p in shortest_pack_first(histogram, max_tokens):
        (plan.kept if max_tokens - p.used <= slack else open_).append(p)
    open_.sort(key=lambda p: -p.used)
    whole, rest = divmod(sum(p.used * p.count for p in open_), max_tokens)
    plan.tail = powers_of_two(rest)
    for p in open_:
        n = min(whole, p.count)
        whole -= n
        if n:
            plan.filled.append(Pattern(p.lengths, p.used, n))
        if p.count > n:
            plan.donors.append(Pattern(p.lengths, p.used, p.count - n))
    at = 0
    for p in [*plan.kept, *plan.filled]:
        p.first, at = at, at + p.count
    return plan


class Places:
    """Sequence, offset and cut of every piece, from its length and rank."""

    def __init__(self, plan: Plan):
        self.max_tokens = plan.max_tokens
        slots: dict[int, list[tuple[int, int, int, int, int, bool]]] = {}
        ranks: dict[int, int] = {}
        line = 0
        for p, donor in [*((p, False) for p in [*plan.kept, *plan.filled]), *((p, True) for p in plan.donors)]:
            offset, base = 0, line if donor else p.first
            for length, copies in p.lengths:
                start = ranks.get(length, 0)
                ranks[length] = start + copies * p.count
                slots.setdefault(length, []).append((start, copies, offset, base, p.used, donor))
                offset += length * copies
            if donor:
                line += p.used * p.count
        self.slots = {length: (np.array([s[0] for s in found]), found) for length, found in slots.items()}
        # the line of room: its ranges by pattern, then the tail
        room = [p.count * (plan.max_tokens - p.used) for p in plan.filled]
        self.room_ends, self.filled = np.cumsum(room), plan.filled
        self.room = int(sum(room))
        self.tail_ends = self.room + np.cumsum(plan.tail, dtype=np.int64)
        self.tail_first = sum(p.count for p in [*plan.kept, *plan.filled])

    def find(self, length: int, rank: int) -> list[tuple[int, int, int]]:
        """(sequence, offset, ids) of the piece, in the order of its ids."""
        starts, found = self.slots[length]
        start, copies, offset, base, used, donor = found[int(np.searchsorted(starts, rank, side="right")) - 1]
        pack, copy = divmod(rank - start, copies)
        offset += copy * length
        if not donor:
            return [(base + pack, offset, length)]
        at, out = base + pack * used + offset, []
        while length:
            if at < self.room:
                i = int(np.searchsorted(self.room_ends, at, side="right"))
                p = self.filled[i]
                gap = self.max_tokens - p.used
                pack, inside = divmod(at - (int(self.room_ends[i]) - p.count * gap), gap)
                n = min(length, gap - inside)
                out.append((p.first + pack, p.used + inside, n))
            else:
                i = int(np.searchsorted(self.tail_ends, at, side="right"))
                begin = int(self.tail_ends[i - 1]) if i else self.room
                n = min(length, int(self.tail_ends[i]) - at)
                out.append((self.tail_first + i, at - begin, n))
            at, length = at + n, length - n
        return out


# --- tokens ----------------------------------------------------------------------


# Places between a letter and an ASCII sign or digit (the apostrophe aside).
_SIGN = r"[!-&(-/0-9:-@\[-`{-~]"
CUT = re.compile(rf"(?<=[^\W\d_])(?={_SIGN})|(?<={_SIGN})(?=[^\W\d_])")
SIGNS = bytes(c for c in range(33, 127) if not chr(c).isalpha() and c != 39)
# Words that may be encoded as one line: Latin letters alone, not the I with a dot (two signs when lower-cased).
LETTERS = "a-zÀ-ÖØ-öø-įı-ɏ"
LETTERS_ONLY = re.compile(f"[{LETTERS}]+")


@lru_cache(maxsize=2)
def encoder_of(path: str, specials: bool, end_id: int) -> Encoder:
    """The encoder of this Python worker, with the words of its earlier tasks."""
    return Encoder(path, specials, end_id)


class Encoder:
    """Ids of texts, as little-endian bytes of the narrowest width that holds the
    vocabulary.

    Where the vocabulary keeps words apart and drops the white space between
    them, words are encoded once for many texts; where it also keeps letters
    apart from ASCII signs and digits (the apostrophe aside), so are the parts
    of a word; where it ignores the case of ASCII letters, so do the kept words.
    All three are tried out on every ASCII sign before use; other vocabularies
    encode whole texts. Where the vocabulary marks the last token of a word, new
    words of Latin letters are encoded a line at a time and told apart by the mark;
    that is tried out on every letter."""

    def __init__(self, path: str, specials: bool, end_id: int):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not specials
        # the same ids, without the places of tokens in the text
        self.encode_batch = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        largest = max(end_id, self.tokenizer.get_vocab_size(with_added_tokens=True) - 1)
        self.width, self.code = (np.dtype("<u2"), "H") if largest < 1 << 16 else (ID, "I")
        signs = [bytes([c]) for c in SIGNS]
        self.words_apart = self._same([b"ab" + w + b"Cd" for w in (b" ", b"\n", b"\t ", b"\r\n", b"\x0b", b"\x0c")], bytes.split) and self._same(
            [c + w + c for c in [*signs, b"'", b"a"] for w in (b" ", b"\n")], bytes.split
        )
        self.signs_apart = not specials and self.words_apart and self._same(
            [x for c in signs for x in (b"ab" + c + b"Cd", c + c + b"ab" + c, b"a" + c + b"1" + c + b"b", b"'s" + c + b"it's" + c)], self._cut
        )
        letters = bytes(range(65, 91))
        self.any_case = not specials and all(self._same([w], lambda x: [x.lower()]) for w in (letters, *(bytes([c]) for c in letters), b"aBbA'S"))
        mark = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = np.zeros(largest + 1, dtype=bool)
        if mark and self.words_apart and self.any_case:
            self.ends[[i for token, i in self.tokenizer.get_vocab(False).items() if token.endswith(mark)]] = True
        letters = [chr(c) for c in range(0x250) if LETTERS_ONLY.fullmatch(chr(c))]
        tried = [x for c in letters for x in (c, c + "a", "b" + c, c + c)]
        self.by_line = bool(self.ends.any()) and self._encode_line(tried) == self._encode([x.encode() for x in tried])
        self.recent: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _same(self, samples: list[bytes], cut) -> bool:
        """Whether the parts of each sample have the ids of the whole."""
        return all(b"".join(self._encode(cut(x))) == b"".join(self._encode([x])) for x in samples)

    def _encode(self, words: list[bytes]) -> list[bytes]:
        out, start, size = [], 0, 0
        for i, w in enumerate(words):
            size += len(w)
            if i + 1 == len(words) or size > ENCODE_BYTES:
                part = [x.decode("utf-8", "replace") for x in words[start : i + 1]]
                found = self.encode_batch(part, add_special_tokens=False)
                out += [pack_ids(f"<{len(ids)}{self.code}", *ids) for ids in (e.ids for e in found)]
                start, size = i + 1, 0
        return out

    def _encode_line(self, words: list[str]) -> list[bytes] | None:
        """Ids of words that are encoded as one text, None where the marks do not tell them apart."""
        ids = np.array(self.encode_batch([" ".join(words)], add_special_tokens=False)[0].ids, dtype=self.width)
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):
            return None
        whole, places = ids.tobytes(), (ends * self.width.itemsize).tolist()
        return [whole[i:j] for i, j in zip([0, *places], places)]

    def _encode_words(self, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """(word, ids) of every word."""
        apart, line = [], {}
        for w in words if self.by_line else []:
            text = w.decode("utf-8", "replace")
            if len(w) <= KEPT_BYTES and LETTERS_ONLY.fullmatch(text):
                line[w] = text
            else:
                apart.append(w)
        joined = list(line)
        for start in range(0, len(joined), LINE_WORDS):
            part = joined[start : start + LINE_WORDS]
            found = self._encode_line([line[w] for w in part])
            if found is None:
                apart += part
            else:
                yield from zip(part, found, strict=True)
        if not self.by_line:
            apart = words
        yield from zip(apart, self._encode(apart), strict=True)

    @staticmethod
    def _cut(word: bytes) -> list[bytes]:
        core = word.rstrip(SIGNS)
        if core.decode("utf-8", "replace").isalpha():  # letters, and signs behind them
            return [core, word[len(core) :]] if len(core) < len(word) else [word]
        return [x.encode() for x in CUT.split(word.decode("utf-8", "replace"))]

    def _ids_of_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of different words: kept ones, or encoded now and kept."""
        if len(self.recent) > KEPT_WORDS:
            self.older, self.recent = self.recent, {}
        recent, older = self.recent, self.older
        out = list(map(recent.get, words))
        gaps = [i for i, x in enumerate(out) if x is None]
        new = [words[i] for i in gaps]
        recent.update({w: older[w] for w in new if w in older})
        cut = {w: self._cut(w) if self.signs_apart and w and not w.isalpha() else [w] for w in new if w not in recent}
        parts = {x for p in cut.values() for x in p}.difference(recent)
        recent.update({x: older[x] for x in parts if x in older})
        unknown = [x for x in parts if x not in recent]
        recent.update(self._encode_words(unknown))
        for w, p in cut.items():
            if p != [w]:
                recent[w] = b"".join([recent[x] for x in p])
        for i, w in zip(gaps, new, strict=True):
            out[i] = recent[w]
        for w in [w for found in (cut, unknown) for w in found if len(w) > KEPT_BYTES]:
            recent.pop(w, None)
        return out

    def ids(self, texts: pa.Array | list[bytes | None]) -> list[bytes]:
        """Ids of every text; a null text has none."""
        raw = pa.array(texts, pa.binary()) if isinstance(texts, list) else texts.cast(pa.binary())
        if not self.words_apart:
            return self._encode([t or b"" for t in raw.to_pylist()])
        plain = raw.view(pa.string())
        # a word is a place in the dictionary of the step, so that it is looked up once
        split = pc.ascii_split_whitespace(pc.ascii_lower(plain) if self.any_case else plain)
        coded = split.values.dictionary_encode()
        if not len(coded):
            return [b""] * len(raw)
        known = pa.array(self._ids_of_words(coded.dictionary.cast(pa.binary()).to_pylist()), pa.binary())
        joined = known.take(coded.indices)
        # the ids of the words of a text lie side by side
        places = np.frombuffer(joined.buffers()[1], dtype=np.int32)[np.asarray(split.offsets)].tolist()
        whole = joined.buffers()[2]
        whole = memoryview(whole) if whole is not None else b""
        return [bytes(whole[i:j]) for i, j in zip(places, places[1:])]


def _tokens(path: str, end_id: int, max_tokens: int, specials: bool):
    """Task: one row per document: its ids, and the rank of its last piece among those of the task."""

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder = encoder_of(path, specials, end_id)
        end, width = np.array([end_id], dtype=encoder.width).tobytes(), encoder.width.itemsize
        seen = np.zeros(max_tokens, dtype=np.int64)
        stretches = 0
        for whole in batches:
            for batch in steps([whole], "text", WORDS_BYTES):
                ids = [x + end for x in encoder.ids(batch.column("text"))]
                n = np.array([len(x) // width for x in ids], dtype=np.int64)
                full, last = n // max_tokens, n % max_tokens
                nth = np.zeros(len(n), dtype=np.int64)
                for i, r in enumerate(last):
                    nth[i], seen[r] = seen[r], seen[r] + 1
                ahead = stretches + np.cumsum(full) - full
                stretches += int(full.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(n), part, dtype=np.int32)),
                        batch.column("doc_id"),
                        pa.array(ids, pa.binary()),
                        pa.array(n),
                        pa.array(last.astype(np.int32)),
                        pa.array(nth),
                        pa.array(ahead),
                    ],
                    ["part", "doc_id", "ids", "n_ids", "last", "nth", "ahead"],
                )

    return run


def _pieces(plan, max_tokens: int):
    """Task: the pieces of every document, from the rank of its last piece."""

    def run(batches):
        places = Places(plan.value)
        for whole in batches:
            for batch in steps([whole], "ids"):
                out = ([], [], [], [], [], [], [])
                cols = [batch.column(c).to_pylist() for c in ("part", "ids", "n_ids", "last", "nth", "ahead", "earlier")]
                for row, (part, ids, n, last, nth, ahead, earlier) in enumerate(zip(*cols, strict=True)):
                    cuts = [(SPAN * (part + 1) + ahead + i, 0, max_tokens) for i in range(n // max_tokens)]
                    if last:
                        cuts += places.find(last, earlier + nth)
                    start, wide = 0, np.frombuffer(ids, dtype=f"<u{len(ids) // n}").astype(ID).tobytes()
                    for sequence, offset, length in cuts:
                        piece = wide[start * ID.itemsize : (start + length) * ID.itemsize]
                        for column, v in zip(out, (row, start, length, piece, n, sequence, offset), strict=True):
                            column.append(v)
                        start += length
                rows, start, length, ids, n, sequence, offset = out
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(rows, pa.int64())),
                        *[pa.array(x, pa.int64()) for x in (start, length)],
                        pa.array(ids, pa.binary()),
                        *[pa.array(x, pa.int64()) for x in (n, sequence, offset)],
                    ],
                    ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
                )

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    max_tokens: int = 4096,
    slack: int = 4,
    specials: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (unsigned 32-bit, little-endian
    bytes), doc_tokens, sequence_id, offset.

    ``tokenizer`` is the path of a vocabulary file that every executor has."""
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = plain.schema["doc_id"].dataType.simpleString()
    tokens = plain.mapInArrow(
        _tokens(tokenizer, end_id, max_tokens, specials),
        f"part int, doc_id {id_type}, ids binary, n_ids long, last int, nth long, ahead long",
    )
    tokens = save(tokens, "pack-tokens")
    # one row per task and length; a length never has more rows here than there are tasks
    counts = save(tokens.where("last > 0").groupBy("part", "last").agg(F.count(F.lit(1)).alias("n")), "pack-counts")
    histogram = {r["last"]: r["n"] for r in counts.groupBy("last").agg(F.sum("n").alias("n")).collect()}
    plan = spark.sparkContext.broadcast(plan_packs(histogram, max_tokens, slack))
    before = Window.partitionBy("last").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = counts.select("part", "last", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    ranked = tokens.join(by_shuffle(earlier), ["part", "last"], "left")
    return ranked.select("part", "doc_id", "ids", "n_ids", "last", "nth", "ahead", "earlier").mapInArrow(
        _pieces(plan, max_tokens),
        f"doc_id {id_type}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long",
    )
