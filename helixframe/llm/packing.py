"""Mixture-controlled packing: deficit round-robin over source queues.

Each source's documents form a queue of tokens. In every round, which is one window of the output, a source is credited
its share of the window and sends whole packets of GRAIN tokens while its credit lasts; what is left of the credit, its
deficit, is carried to the next round. All that a source has sent after k rounds is therefore
min(its tokens, GRAIN * floor(k * credit / GRAIN)), a closed form, and so is the place of every packet in the output. A task
thus needs no state of earlier windows or other tasks, only the table of totals: deficits carry over partitions for free.

The rounds follow each other without a gap and are cut at every window's length, so that only the last window is padded.
Packets of a document that land next to each other are one piece.

Sources' shares of a window default to WEIGHTS in turn, in the order of their names; queues that end early leave their place to the
rest. MOST_QUEUES queues are scheduled: with more sources than that, a queue is shared by those of one hash, whose shares add up.

Null and empty texts are documents of the end token alone; null sources form a queue; null ids are allowed; rows that repeat
are documents of their own. An empty table gives no pieces, further columns are ignored whatever their names. Texts of any length are encoded
whole; words are encoded once per task and
looked up after that, in a table that is emptied when it holds MOST_WORDS.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.llm.common import give_back, materialise, read_table, slices, small_batches, split_words, whole_texts

WINDOW, END_ID, GRAIN = 2048, 1, 128
MOST_QUEUES, MOST_WORDS = 4096, 300_000
#: Weights of the sources in order of their names, null last, in turn.
WEIGHTS = (5, 2, 1)
VOCABULARY = "word_bpe_49k.json"


#: ASCII punctuation after one of these letters or digits begins another token, whatever comes before or after.
_MARK = r"([A-Za-z0-9\x{df}-\x{f6}\x{f8}-\x{ff}])([!-/:-@\[-`{-~])"
#: Such a word is one piece for the tokenizer's model, which takes bytes as the letters that stand for them.
_SIMPLE = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+").fullmatch


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: printable ones for themselves, the others from U+0100 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


_LETTERS = _byte_letters()


class Encoder:
    """Token ids of texts, word by word.

    The tokenizer lower-cases, and joins no characters over white space or over the step from a letter to punctuation.
    Texts are so cut into fewer different words than they have, each of which is encoded once and looked up.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.bounds, self.used = np.zeros(1 << 20, np.uint16), np.zeros(1 << 16, np.int32), 0

    def _encoded(self, words: list[str]) -> list[list[int]]:
        tokens = self.tokenizer.model.tokenize
        out: list = [[t.id for t in tokens(w if w.isascii() else w.encode().decode("latin-1").translate(_LETTERS))] if _SIMPLE(w) else None for w in words]
        others = [i for i, ids in enumerate(out) if ids is None]
        for i, e in zip(others, self.tokenizer.encode_batch_fast([words[i] for i in others], add_special_tokens=False)):
            out[i] = e.ids
        return out

    def _learn(self, words: list[str]) -> None:
        for at in range(0, len(words), 8192):
            part = words[at : at + 8192]
            ids = self._encoded(part)
            sizes = list(map(len, ids))
            new = np.fromiter(chain.from_iterable(ids), np.uint16, sum(sizes))
            while self.used + len(new) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            self.flat[self.used : self.used + len(new)] = new
            first = len(self.known)
            if first + len(part) >= len(self.bounds):
                self.bounds = np.concatenate([self.bounds, np.zeros_like(self.bounds)])
            self.known.update(zip(part, range(first, first + len(part))))
            self.bounds[first + 1 : first + 1 + len(part)] = self.used + np.cumsum(sizes)
            self.used += len(new)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts, each text followed by the end id, and the number of ids of each text."""
        words, counts = split_words(_simplified(whole_texts(texts)))
        coded = words.dictionary_encode()
        spelled = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > MOST_WORDS:
            self._forget()
        self._learn([w for w in spelled if w not in self.known])
        index = np.fromiter(map(self.known.__getitem__, spelled), np.int64, len(spelled))
        codes = index[coded.indices.to_numpy(zero_copy_only=False)]
        starts = self.bounds[codes].astype(np.int64)
        lengths = self.bounds[codes + 1] - starts
        ends = np.cumsum(lengths)
        text = np.repeat(np.arange(len(counts)), counts)
        sums = np.bincount(text, weights=lengths, minlength=len(counts)).astype(np.int64)
        total = int(sums.sum())
        # The ids of all words in a row, then a place for each end.
        row = self.flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]
        out = np.full(total + len(counts), END_ID, np.uint32)
        full = np.ones(len(out), bool)
        full[np.cumsum(sums + 1) - 1] = False
        out[full] = row
        return out, sums + 1


def _simplified(texts: pa.Array) -> pa.Array:
    """The texts with fewer different words and the same tokens: in lower case, and cut before marks.

    Beyond Latin-1 only A-Z change their case, because tables of cases differ. Texts with `<|` stay: a mark of the tokenizer
    is told from others by its exact spelling.
    """
    wide = pc.match_substring_regex(texts, r"[^\x00-\x{ff}]")
    lowered = pc.if_else(wide, pc.ascii_lower(texts), pc.utf8_lower(pc.if_else(wide, "", texts)))
    return pc.if_else(pc.match_substring(texts, "<|"), texts, pc.replace_substring_regex(lowered, pattern=_MARK, replacement=r"\1 \2"))


TOKENISED = "doc_id long, source string, n long, before long, part long, ids binary"


def tokenise(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, source, n, before, part, ids): ids as little-endian 32-bit numbers; before: ids of the source earlier in the part.

    A part is what one task reads. The result has to be written before it is used: its order is then fixed.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen, part = Encoder(path), {}, TaskContext.get().partitionId()
        for batch in batches:
            give_back()
            for piece in slices(batch, "text", 2 << 20):
                ids, counts = encoder(piece.column(2))
                before = []
                for source, n in zip(piece.column(1).to_pylist(), counts.tolist()):
                    before.append(seen.get(source, 0))
                    seen[source] = before[-1] + n
                offsets = np.concatenate([[0], np.cumsum(counts)]) * 4
                binary = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(ids)])
                yield pa.record_batch([piece.column(0), piece.column(1), pa.array(counts), pa.array(before, pa.int64()), pa.array(np.full(len(counts), part)), binary.cast(pa.binary())], ["doc_id", "source", "n", "before", "part", "ids"])

    small_batches(docs.sparkSession)
    return docs.select("doc_id", "source", "text").mapInArrow(encode, TOKENISED)


@dataclass(frozen=True)
class Plan:
    """Totals of the queues and their packets per round. All that a task needs to place a packet."""

    totals: np.ndarray
    rate: np.ndarray

    def sent(self, rounds: np.ndarray) -> np.ndarray:
        """Tokens sent by each queue after so many rounds: a row for each entry of rounds."""
        return np.minimum(self.totals[None, :], GRAIN * np.floor(rounds[:, None] * self.rate[None, :]).astype(np.int64))

    def round_of(self, queue: np.ndarray, packet: np.ndarray) -> np.ndarray:
        """The round, from 1, in which a queue sends its packet (from 0): the first after which its credit sufficed."""
        rate = self.rate[queue]
        k = np.ceil((packet + 1) / rate).astype(np.int64)
        for _ in range(2):  # what floating point left over
            k -= (k > 1) & (np.floor((k - 1) * rate) > packet)
            k += np.floor(k * rate) <= packet
        return k

    def place(self, queue: np.ndarray, packet: np.ndarray) -> np.ndarray:
        """The position in the output of the first token of each packet."""
        k = self.round_of(queue, packet)
        out = np.empty(len(k), np.int64)
        rounds, inverse = np.unique(k, return_inverse=True)
        step = max(1, (1 << 21) // max(1, len(self.totals)))
        for at in range(0, len(rounds), step):
            here = np.flatnonzero((inverse >= at) & (inverse < at + step)) if len(rounds) > step else slice(None)
            until, now = self.sent(rounds[at : at + step] - 1), self.sent(rounds[at : at + step])
            # Queues before this one have sent in this round, itself and the later ones only in the rounds before.
            gained = np.cumsum(now - until, axis=1) - (now - until)
            start = until.sum(axis=1)[:, None] + gained - until
            out[here] = start[inverse[here] - at, queue[here]] + GRAIN * packet[here]
        return out


def plan_of(totals: list[int], shares: list[float] | None = None) -> Plan:
    t = np.array(totals, np.int64)
    s = t.astype(float) if shares is None else np.array(shares, float)
    if len(s) and not (s > 0).all():
        raise ValueError("each queue needs a share above 0")
    return Plan(t, WINDOW * s / max(s.sum(), 1e-300) / GRAIN)


def pieces(plan: Plan, queue: np.ndarray, rank: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cuts documents (queue, rank of their first token in it, length) to pieces: document, start, length, position."""
    first, last = rank // GRAIN, (rank + n - 1) // GRAIN
    per = last - first + 1
    doc = np.repeat(np.arange(len(n)), per)
    packet = np.arange(int(per.sum())) - np.repeat(np.cumsum(per) - per, per) + first[doc]
    begin = np.maximum(packet * GRAIN, rank[doc])
    length = np.minimum((packet + 1) * GRAIN, rank[doc] + n[doc]) - begin
    at = plan.place(queue[doc], packet) + begin - packet * GRAIN
    # A packet that crosses the end of a window is cut there; GRAIN is at most a window, so once.
    room = WINDOW - at % WINDOW
    cut = length > room
    order = np.argsort(np.concatenate([np.arange(len(doc)), np.flatnonzero(cut) + 0.5]), kind="stable")
    join = lambda a, b: np.concatenate([a, b])[order]
    start = begin - rank[doc]
    doc, start, size, at = join(doc, doc[cut]), join(start, (start + room)[cut]), join(np.where(cut, room, length), (length - room)[cut]), join(at, (at + room)[cut])
    fresh = np.concatenate([[True], (doc[1:] != doc[:-1]) | (at[1:] != at[:-1] + size[:-1]) | (at[1:] // WINDOW != at[:-1] // WINDOW)]) if len(doc) else np.zeros(0, bool)
    head = np.flatnonzero(fresh)
    return doc[head], start[head], np.add.reduceat(size, head) if len(head) else size, at[head]


PIECES = "doc_id long, source string, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def pack(docs: DataFrame, path: str, shares: dict[str | None, float] | None = None) -> DataFrame:
    """Pieces of all documents with their ids (little-endian 32-bit numbers), sequence and offset.

    shares: the parts that the sources' tokens should have in a window, by name; by default WEIGHTS in turn.
    """
    tokens = materialise(tokenise(docs, path), "packing-tokens")
    sums = materialise(tokens.groupBy("source", "part").agg(F.sum("n").alias("n")), "packing-sums")
    # One row a source: its share is taken in the order of the names, then queues are made.
    by_name = Window.partitionBy(F.lit(1)).orderBy(F.col("source").asc_nulls_last())
    names = sums.groupBy("source").agg(F.sum("n").alias("total")).withColumn("share", F.get(F.array(*map(F.lit, WEIGHTS)), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(WEIGHTS)))).cast("double"))
    if shares is not None:
        given = docs.sparkSession.createDataFrame([(k, float(x)) for k, x in shares.items()], "name string, given double")
        names = names.join(given, F.col("source").eqNullSafe(F.col("name")), "left").select("source", "total", F.coalesce("given", F.lit(0.0)).alias("share"))
    queue = F.col("source")
    if names.count() > MOST_QUEUES:
        queue = F.pmod(F.xxhash64("source"), F.lit(MOST_QUEUES)).cast("string")
    queues = names.groupBy(queue.alias("source")).agg(F.sum("total").alias("total"), F.sum("share").alias("share"))
    listed = sorted(queues.collect(), key=lambda r: (r["source"] is None, r["source"] or ""))  # at most MOST_QUEUES rows
    plan = plan_of([r["total"] for r in listed], [r["share"] for r in listed])
    number = {r["source"]: i for i, r in enumerate(listed)}
    # Parts in order, and in a part the sources of a queue in order: where a queue's tokens of a part and source begin.
    order = Window.partitionBy("queue").orderBy("part", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.withColumn("queue", queue).withColumn("base", F.coalesce(F.sum("n").over(order), F.lit(0))).select(F.col("source").alias("of"), F.col("part").alias("in"), "queue", "base")
    ranked = tokens.join(bases, F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("in"))).select("doc_id", "source", "n", "queue", (F.col("base") + F.col("before")).alias("rank"), "ids")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            give_back()
            for part in slices(batch, "ids", 2 << 20):
                n, rank = (part.column(i).to_numpy(zero_copy_only=False) for i in (2, 4))
                mine = np.array([number[q] for q in part.column(3).to_pylist()], np.int64)
                doc, start, length, at = pieces(plan, mine, rank, n)
                ids = part.column(5).cast(pa.large_binary())
                data = np.frombuffer(ids.buffers()[2], np.uint8)
                base = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset : ids.offset + len(n)]
                # Pieces of a document follow each other and cover it, so that the buffer stays and gets finer offsets.
                offsets = np.append(base[doc] + 4 * start, base[-1] + 4 * n[-1])
                binary = pa.Array.from_buffers(pa.large_binary(), len(doc), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).cast(pa.binary())
                taken = pa.array(doc)
                yield pa.record_batch([part.column(0).take(taken), part.column(1).take(taken), pa.array(start), pa.array(length), pa.array(n[doc]), pa.array(at // WINDOW), pa.array(at % WINDOW), binary], ["doc_id", "source", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    return ranked.mapInArrow(cut, PIECES)


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def digest(packed: DataFrame) -> DataFrame:
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack(read_table(spark, sf_dir, "documents"), vocabulary_path()))


QUERIES = {"op1_packing": op1_packing}
ORACLES: dict[str, str] = {}
