"""Language-model scores by online logistic context mixing.

What is learned from the training documents: the counts of all words; the counts of all blocks, passages between cuts that
the words before them decide, of BLOCK words on average; bit counts of hashed contexts, (word before, place in the code), for
the next word; and, from all distinct words, bit counts of hashed contexts for spelling a word that the corpus doesn't know.

A text is coded as binary decisions: whether a whole block repeats one of the training documents (other than itself); whether
a token is the one that followed the last two the last time; whether it is unknown; and then BITS bits of its word's code, the
first of which come from the hash of the word's ending and the others from that of the word. Each decision has four predictors: the corpus's frequency of its place in the code, the corpus's context of the word before, and the
text's own two tables, by place and by (word before, place). Their logits are mixed with weights that the decision's kind
selects (the gate); own tables learn from each decision, weights from each token, and a last table refines the mixed
probability by what happened at it before. Within the words of its code a token has its share of their counts; an unknown word is spelled in bits of
its bytes, whose four context orders are mixed by weights that learn along the word.

All adaptive state is a text's own and is carried from its first token to its last, and learns after each of them. What a text scores depends on no other text of its chunk; texts are coded side by
side in numpy. `bits_per_byte` is the cost by the text's bytes.

Null texts count as empty: one end token. Null ids are allowed (their remainder is that of empty text), rows that repeat
are scored one by one, an empty table gives no rows, further columns are ignored whatever their names, and without any
training document every word is unknown.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import binascii
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.llm.common import gathered, give_back, materialise, read_table, slices, small_batches, split_words

HELD_OUT_MODULUS, HELD_OUT_REMAINDER = 7, 2
#: Texts coded side by side: their refining tables' cells have numbers of 16 bits.
LANES, CHUNK_BYTES = 1984, 14 << 20
#: Tasks whose chunks count a key together before districts are added up: a common word has a row in each chunk.
DISTRICT_TASKS = 4096
#: Bits of a word's code, and those of them that its last ENDING letters decide; slots of the contexts of the corpus and of a text.
BITS, ENDING_BITS, ENDING, CORPUS_SLOTS, OWN_SLOTS, FOLLOW_SLOTS = 8, 6, 2, 1 << 17, 1 << 9, 1 << 10
NODES = 1 << BITS
#: Words of a block on average and at least.
BLOCK, LEAST_BLOCK = 16, 6
#: A text learns after each of its tokens; from the STEADY-th on it would after AHEAD tokens, which no text reaches.
STEADY, AHEAD = 1 << 62, 32
#: Tokens, of all texts and of one, whose decisions are laid out at a time.
WINDOW, GATHERED = 1 << 14, 64
#: Kinds of decisions before those of the code's bits; contexts of each in a text's own table.
REPEATS, FOLLOWS, UNKNOWN, KINDS, KIND_SLOTS = 0, 1, 2, 3, 32
WIDTH = NODES + OWN_SLOTS + KINDS * KIND_SLOTS
#: Learning rates of weights and refining table, the share that the latter decides, shifts by which own tables learn.
WEIGHT_RATE, REFINE_RATE, REFINE_SHARE, SHIFTS = 0.015, 0.02, 0.25, (5, 4)
CELLS, MOST_LOGIT = 33, 10.0
#: First weights of the four predictors, of the kinds and of the code's bits.
FIRST_KIND, FIRST_BIT = (0.3, 0.0, 0.4, 0.3), (0.3, 0.3, 0.6, 0.1)
REPEAT_START, FOLLOW_START = 0.01, 0.2
_STRETCH = np.log((np.arange(4096) + 0.5) / (4095.5 - np.arange(4096))).astype(np.float32)
_SHIFTS = np.array(SHIFTS)[:, None].astype(np.int32)
_C1, _C2 = 0x9E3779B1, 0x85EBCA6B27
#: Table sizes of the spelling contexts of no, one, two and three bytes before.
SPELL_SIZES = (1 << 8, 1 << 16, 1 << 17, 1 << 17)
SPELL_STARTS = np.cumsum([0, *SPELL_SIZES])
SPELL_DOUBT, SPELL_RATE, SPELL_LEARNS = 1.5, 0.004, 32

ROWS = "cid long, doc_id long, held_out boolean, n_bytes long, codes binary, blocks binary, word string, gram long, code int, mark int, n_train long, ones long"
_ROWS = pa.schema([("cid", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_bytes", pa.int64()), ("codes", pa.binary()), ("blocks", pa.binary()), ("word", pa.string()), ("gram", pa.int64()), ("code", pa.int32()), ("mark", pa.int32()), ("n_train", pa.int64()), ("ones", pa.int64())])


def _rows(n: int, **columns) -> pa.RecordBatch:
    return pa.record_batch([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _ROWS], schema=_ROWS)


def _cells(lengths: np.ndarray, data: np.ndarray) -> pa.Array:
    """A binary column whose values are runs of an int32 array."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64) * 4
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data, np.int32))]).cast(pa.binary())


def _runs(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The int32 numbers of all cells of such a column, and how many each cell has."""
    blobs = column.combine_chunks().cast(pa.large_binary())
    sizes = pc.binary_length(blobs).to_numpy(zero_copy_only=False).astype(np.int64) // 4
    data = np.frombuffer(blobs.buffers()[2] or b"", np.int32)
    first = np.frombuffer(blobs.buffers()[1], np.int64)[blobs.offset] // 4
    return data[first : first + sizes.sum()], sizes


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def before(marks: np.ndarray) -> np.ndarray:
    """What a word adds to the contexts of the next one."""
    return ((marks.astype(np.int64) & 0xFFFF) + 1) * _C1


def word_hashes(words: pa.Array) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w, 42) for w in words.cast(pa.large_binary()).to_pylist()], np.uint64)


def symbols(words: pa.Array, hashes: np.ndarray) -> np.ndarray:
    """The code of each word."""
    endings = pc.utf8_slice_codeunits(words, -ENDING).dictionary_encode()
    ending = word_hashes(endings.dictionary)[endings.indices.to_numpy(zero_copy_only=False)]
    high, low = (h >> np.uint64(64 - b) for h, b in ((ending, ENDING_BITS), (hashes, BITS - ENDING_BITS)))
    return (high << np.uint64(BITS - ENDING_BITS) | low).astype(np.int64)


def marks_of(words: pa.Array, hashes: np.ndarray) -> np.ndarray:
    """What is known of each word by itself: its code, and sixteen bits of its hash for the contexts of the next word."""
    return (symbols(words, hashes) << 16 | (hashes & np.uint64(0xFFFF)).astype(np.int64)).astype(np.int32)


def blocks_of(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start in it, length, key) of each block of at least LEAST_BLOCK tokens; a cut follows two words whose hash says so."""
    text = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    place = np.arange(len(hashes), dtype=np.int32) - (np.cumsum(counts) - counts).astype(np.int32)[text]
    cut = place == 0
    cut[2:] |= (place[2:] >= 2) & (_mixed(hashes[1:-1] + np.uint64(0x9E3779B97F4A7C15) * hashes[:-2]) % np.uint64(BLOCK) == 0)
    start = np.flatnonzero(cut)
    length = np.diff(np.append(start, len(hashes)))
    inside = (np.arange(len(hashes), dtype=np.int32) - np.repeat(start.astype(np.int32), length)).astype(np.uint64)
    keys = np.add.reduceat(_mixed(hashes + inside * np.uint64(0xD6E8FEB86659FD93)), start) if len(start) else np.zeros(0, np.uint64)
    full = length >= LEAST_BLOCK
    return text[start[full]], place[start[full]], length[full], keys[full]


def context_counts(seen: np.ndarray, previous: np.ndarray, codes: np.ndarray) -> None:
    """Adds the bits of tokens (their symbols) after words to the counts (slot, bit)."""
    node = np.ones(len(codes), np.int64)
    for d in range(BITS):
        bit = codes >> (BITS - 1 - d) & 1
        slot = (previous + node * _C2) >> 12 & (CORPUS_SLOTS - 1)
        seen += np.bincount(2 * slot + bit, minlength=len(seen))
        node = 2 * node + bit


def chunk_codes(piece: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """word_codes() of a chunk's texts, some megabytes at a time: all words at once take many times the chunk's size."""
    parts = []
    for p in slices(piece, "text"):
        words, counts = split_words(p.column(1), lower=True)
        parts.append((words.dictionary_encode(), counts))
        del words
    coded = pa.chunked_array([c for c, _ in parts]).unify_dictionaries()
    codes = [c.indices.to_numpy(zero_copy_only=False).astype(np.int32) for c in coded.chunks]
    return np.concatenate(codes), np.concatenate([n for _, n in parts]), coded.chunk(coded.num_chunks - 1).dictionary


def chunked(docs: DataFrame) -> DataFrame:
    """Chunks of documents as word codes (rows with codes), each with its own dictionary (rows with a word or a block's key).

    The end token is the empty word, which no text can hold. A chunk's dictionary is what later steps shuffle: one row for
    each distinct word and block of some megabytes of text. A task's context counts come last (rows with ones).
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cid, seen = TaskContext.get().partitionId() << 24, np.zeros(2 * CORPUS_SLOTS, np.int64)
        for piece in gathered(batches, "text", CHUNK_BYTES):
            ids, texts = piece.column(0), piece.column(1)
            codes, counts, words = chunk_codes(piece)
            end = len(words)
            words = pa.concat_arrays([words.cast(pa.large_string()), pa.array([""], pa.large_string())])
            hashes = word_hashes(words)
            marks = marks_of(words, hashes)
            adds, symbol = np.append(before(marks), 0), (marks >> 16).astype(np.int64)
            held = np.array([binascii.crc32(b"" if i is None else str(i).encode()) % HELD_OUT_MODULUS == HELD_OUT_REMAINDER for i in ids.to_pylist()], bool)
            train, full, blocks, at = np.zeros(end + 1, np.int64), np.empty(len(codes) + len(counts), np.int32), [], 0
            # A piece's tokens are some hundred thousand, since what they need beside their codes is many times as large.
            edges = np.flatnonzero(np.diff((np.cumsum(counts) - counts) >> 17, prepend=-1))
            for a, b in zip(edges, np.append(edges[1:], len(counts))):
                mine, size = counts[a:b], int(counts[a:b].sum())
                piece = full[at + a : at + a + size + (b - a)]  # each text's codes, then the end's
                piece[:] = end
                piece[np.arange(size) + np.repeat(np.arange(b - a), mine)] = codes[at : at + size]
                at, mine = at + size, mine + 1
                text, start, length, keys = blocks_of(hashes[piece], mine)
                blocks.append((text + np.int32(a), start, length.astype(np.int32), keys))
                previous = np.append(-1, piece[:-1])
                previous[np.cumsum(mine) - mine] = -1  # no word comes before
                learn = np.repeat(~held[a:b], mine)
                train += np.bincount(piece[learn], minlength=end + 1)
                context_counts(seen, adds[previous[learn]], symbol[piece[learn]])
            del codes
            counts = counts + 1
            text, start, length, keys = (np.concatenate(c) for c in zip(*blocks)) if blocks else blocks_of(hashes[full], counts)
            grams, gram = np.unique(keys, return_inverse=True)
            grams_train = np.bincount(gram[~held[text]], minlength=len(grams))
            sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            triples = np.stack([start, length, gram], axis=1).astype(np.int32).reshape(-1)
            n, m, g = len(counts), end + 1, len(grams)
            yield _rows(n, cid=np.full(n, cid), doc_id=ids, held_out=held, n_bytes=sizes, codes=_cells(counts, full), blocks=_cells(3 * np.bincount(text, minlength=n), triples))
            yield _rows(m, cid=np.full(m, cid), word=words.to_pylist(), code=np.arange(m, dtype=np.int32), mark=marks, n_train=train.astype(np.int64))
            yield _rows(g, cid=np.full(g, cid), gram=grams.view(np.int64), code=np.arange(g, dtype=np.int32), n_train=grams_train.astype(np.int64))
            cid += 1
            give_back()
        zeros, ones = seen[::2], seen[1::2]
        slot = np.flatnonzero(zeros + ones)
        yield _rows(len(slot), code=slot.astype(np.int32), n_train=zeros[slot], ones=ones[slot])

    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(split, ROWS)


def counted(rows: DataFrame, district_tasks: int | None = None) -> DataFrame:
    """Adds c, the count of each key (word or gram) in all chunks, and first, true in one row of each key.

    Chunks are counted by districts: a key has as many rows in one as it has chunks there, and one row a district after that.
    """
    district = F.shiftright("cid", 24) / (district_tasks or DISTRICT_TASKS)
    placed = rows.withColumn("district", F.floor(district).cast("int"))
    here = Window.partitionBy("word", "gram", "district")
    summed = placed.withColumn("c", F.sum("n_train").over(here)).withColumn("first", F.min("cid").over(here) == F.col("cid"))
    if not (rows.agg(F.max(F.shiftright("cid", 24) >= (district_tasks or DISTRICT_TASKS))).first()[0] or False):
        return summed.drop("district")
    kept = materialise(summed, "scoring-districts")
    every = Window.partitionBy("word", "gram")
    totals = kept.where("first").withColumn("c", F.sum("c").over(every)).withColumn("main", F.min("district").over(every) == F.col("district"))
    totals = totals.select(F.col("word").alias("w"), F.col("gram").alias("g"), F.col("district").alias("d"), "c", "main")
    same = F.col("word").eqNullSafe(F.col("w")) & F.col("gram").eqNullSafe(F.col("g")) & (F.col("district") == F.col("d"))
    return kept.drop("c").join(totals, same).withColumn("first", F.col("first") & F.col("main")).drop("w", "g", "d", "main", "district")


def spelling(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all bits of all words and their final spaces: the word, the bit, and its slot in each order's table."""
    data = np.frombuffer(b" ".join([*words, b""]), np.uint8).astype(np.int64)
    sizes = np.array([len(w) + 1 for w in words], np.int64)
    word = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    back = []
    for n in (1, 2, 3):
        shifted = np.concatenate([np.full(min(n, len(data)), 32), data[: max(0, len(data) - n)]])
        back.append(np.where(place >= n, shifted, 32))
    slots = np.empty((len(SPELL_SIZES), len(data), 8), np.int64)
    bits = np.empty((len(data), 8), np.int64)
    two, three = back[0] | back[1] << 8, back[0] | back[1] << 8 | back[2] << 16
    for b in range(8):
        node = (1 << b) | (data >> (8 - b))
        bits[:, b] = data >> (7 - b) & 1
        slots[0, :, b] = node
        slots[1, :, b] = SPELL_STARTS[1] + (back[0] << 8 | node)
        for order, context in ((2, two), (3, three)):
            mixed = (context * 0x9E3779B1 + node * 0x85EBCA6B + order) & 0xFFFFFFFF
            slots[order, :, b] = SPELL_STARTS[order] + (mixed * 0x2C1B3C6D >> 12) % SPELL_SIZES[order]
    return np.repeat(word, 8), bits.reshape(-1), slots.reshape(len(SPELL_SIZES), -1)


def spelling_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bit counts (slot, zeros, ones) over a task's words."""
    seen = np.zeros((2, SPELL_STARTS[-1]), np.int64)
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            words = batch.column(0).slice(at, 4096).cast(pa.binary()).to_pylist()
            _, bits, slots = spelling(words)
            for b in (0, 1):
                seen[b] += np.bincount(slots[:, bits == b].reshape(-1), minlength=seen.shape[1])
    used = np.flatnonzero(seen.sum(axis=0))
    yield pa.record_batch([pa.array(used), pa.array(seen[0, used]), pa.array(seen[1, used])], ["slot", "zeros", "ones"])


def _logit(p):
    return np.log(p / (1 - p))


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


@dataclass(frozen=True)
class Model:
    """What was learned and has a fixed size; the counts of words and blocks come with each chunk."""

    tokens: int  # N
    distinct: int  # V
    singles: int  # words that occur once
    blocks: int  # blocks of training documents, repeats included
    masses: np.ndarray  # count of the words of each symbol
    contexts: np.ndarray  # zeros and ones of each context of the corpus
    spell: np.ndarray  # zeros and ones of each spelling slot

    def fixed(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logits of the code's nodes, of the corpus's contexts and of the other kinds."""
        share, nodes = self.masses.astype(float) + 1e-3, np.zeros(NODES)
        for node in range(1, NODES):
            depth = node.bit_length() - 1
            width = NODES >> depth
            low = (node - (1 << depth)) * width
            nodes[node] = _logit(np.clip(share[low + width // 2 : low + width].sum() / share[low : low + width].sum(), 1e-4, 1 - 1e-4))
        kinds = _logit(np.array([REPEAT_START, FOLLOW_START, np.clip((self.singles + 0.5) / (self.tokens + 1), 1e-4, 0.9)]))
        return nodes.astype(np.float32), np.log((self.contexts[1] + 0.4) / (self.contexts[0] + 0.4)).astype(np.float32), kinds.astype(np.float32)

    def spelled(self, words: list[bytes]) -> np.ndarray:
        """Bits that each word costs when spelled.

        Predictors: a chain over the orders, in which a context counts as it was seen often, and each order for itself. A word's weights
        learn from each of its first SPELL_LEARNS bytes.
        """
        out = np.zeros(len(words))
        for at in range(0, len(words), 4096):
            part = words[at : at + 4096]
            word, bits, slots = spelling(part)
            x = np.empty((len(SPELL_SIZES), len(bits)), np.float32)
            chain = np.zeros(len(bits))
            for order in range(len(SPELL_SIZES)):
                zeros, ones = self.spell[0, slots[order]], self.spell[1, slots[order]]
                own, trust = np.log((ones + 0.3) / (zeros + 0.3)), (zeros + ones) / (zeros + ones + SPELL_DOUBT)
                chain = (1 - trust) * chain + trust * own
                if order:
                    x[order] = own
            x[0] = chain
            x, bits, owner = x.reshape(len(x), -1, 8), bits.reshape(-1, 8), word[::8]
            sizes = np.bincount(owner, minlength=len(part))
            first, cost = np.cumsum(sizes) - sizes, np.zeros(len(bits))
            w = np.tile(np.array([[1.0], [0.0], [0.0], [0.0]], np.float32), (1, len(part)))

            def coded(rows, mine):
                p = np.clip(_sigmoid(np.einsum("km,kmb->mb", w[:, mine], x[:, rows])), 1e-4, 1 - 1e-4)
                cost[rows] = -np.log2(np.where(bits[rows] == 1, p, 1 - p)).sum(axis=1)
                return bits[rows] - p

            for j in range(min(int(sizes.max()), SPELL_LEARNS)):
                mine = np.flatnonzero(sizes > j)
                missed = coded(first[mine] + j, mine)
                w[:, mine] += SPELL_RATE * np.einsum("mb,kmb->km", missed, np.clip(x[:, first[mine] + j], -8, 8))
            late = np.flatnonzero(np.arange(len(bits)) - first[owner] >= SPELL_LEARNS)
            coded(late, owner[late])
            out[at : at + len(part)] = np.bincount(owner, weights=cost, minlength=len(part))
        return out


class Lanes:
    """The adaptive state of texts that are coded side by side."""

    def __init__(self, n: int, model: Model):
        self.nodes, self.contexts, self.kinds = model.fixed()
        own = np.full(WIDTH, 0.5)
        own[:NODES] = _sigmoid(self.nodes)
        own[NODES + OWN_SLOTS :] = np.repeat(_sigmoid(self.kinds), KIND_SLOTS)
        self.table = np.tile((own * 65535).astype(np.int32), n)
        # A column of weights for each lane and gate: kinds, then the bits of the ending and the others.
        self.weights = np.tile(np.array([[*FIRST_KIND]] * KINDS + [[*FIRST_BIT]] * 2, np.float32).T, (1, n))
        self.refine = np.tile(_sigmoid(np.linspace(-MOST_LOGIT, MOST_LOGIT, CELLS)), n)

    def refined(self, lane: np.ndarray, mixed: np.ndarray, bit: np.ndarray) -> np.ndarray:
        """What the refining table holds for each decision (in order) before it learns from it; mixed logits choose the cell.

        A cell's moving average over its decisions is a sum of bits with growing weights; GATHERED tokens bound these.
        """
        key = lane * CELLS + (mixed * np.float32((CELLS - 1) / (2 * MOST_LOGIT)) + np.float32(CELLS / 2)).astype(np.int32)
        order = np.argsort(key.astype(np.uint16), kind="stable")
        key = key[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        sizes = np.diff(np.append(first, len(key)))
        group = np.repeat(np.arange(len(first)), sizes)
        rank = np.arange(len(key)) - first[group]
        decay = (1 - REFINE_RATE) ** np.arange(sizes.max() + 2)
        adds = REFINE_RATE * bit[order] / decay[rank + 1]
        sums = np.cumsum(adds)
        last = first + sizes - 1
        sums -= (sums[first] - adds[first])[group]
        held = self.refine[key[first]]
        out = np.empty(len(key))
        out[order] = decay[rank] * (held[group] + sums - adds)
        self.refine[key[first]] = decay[sizes] * (held + sums[last])
        return out


@dataclass(frozen=True)
class Events:
    """What is left to code of all texts, in order: tokens, and blocks that repeat (asked 2); asked 1: a block that doesn't begins."""

    code: np.ndarray
    asked: np.ndarray
    before: np.ndarray  # the code before, or -1
    pair: np.ndarray  # slot of the last two words


def _runs_before(bit: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How many set bits stand right before each place, up to 15; first: places where a text begins."""
    at = np.arange(len(bit))
    reset = np.where(np.concatenate([[True], ~bit[:-1]]) | first, at, 0)
    return np.minimum(at - np.maximum.accumulate(reset), 15).astype(np.uint8)


@dataclass(frozen=True)
class History:
    """What the decisions on whole tokens depend on: the text before only, so that it is known ahead."""

    repeats: np.ndarray  # repeated blocks in a row before, where a block is asked about
    news: np.ndarray  # blocks in a row before that weren't
    guessed: np.ndarray  # whether the last two words stood before
    hit: np.ndarray  # whether the same token followed
    run: np.ndarray  # hits in a row before

    @staticmethod
    def of(e: Events, text: np.ndarray) -> History:
        """text: the number of each event's text, in order."""
        out = History(*(np.zeros(len(text), t) for t in (np.uint8, np.uint8, bool, bool, np.uint8)))
        if len(some := np.flatnonzero(e.asked)):
            first, again = np.diff(text[some], prepend=-1) > 0, e.asked[some] == 2
            out.repeats[some], out.news[some] = _runs_before(again, first), _runs_before(~again, first)
        if len(token := np.flatnonzero(e.asked != 2)):
            key, code = text[token].astype(np.int64) * FOLLOW_SLOTS + e.pair[token], e.code[token]
            order = np.argsort(key, kind="stable")
            same = np.diff(key[order], prepend=-1) == 0
            follows = np.concatenate([[False], code[order][1:] == code[order][:-1]]) & same
            out.guessed[token[order]], out.hit[token[order]] = same, follows
            out.run[token] = _runs_before(out.hit[token], np.diff(text[token], prepend=-1) > 0)
        return out


def _code_decisions(lane: np.ndarray, symbol: np.ndarray, previous: np.ndarray, lanes: Lanes) -> tuple:
    """The bits of words' codes after a word, a row a bit: bits, both fixed logits, both slots, and the last bit before with the same own slot (or -1)."""
    depth = np.arange(BITS)[:, None]
    bit, node = symbol >> (BITS - 1 - depth) & 1, (1 << depth) + (symbol >> (BITS - depth))
    context = previous + node * _C2
    own = (context >> 20 & (OWN_SLOTS - 1)).astype(np.int32)
    twin = np.full(own.shape, -1, np.int8)
    for d in range(1, BITS):
        for c in range(d):
            twin[d][own[d] == own[c]] = c
    base = lane * WIDTH
    return bit, lanes.nodes[node], lanes.contexts[context >> 12 & (CORPUS_SLOTS - 1)], base + node, base + NODES + own, twin


def stream_costs(e: Events, symbol: np.ndarray, adds: np.ndarray, unknown: np.ndarray, rest: np.ndarray, model: Model, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Bits of each text (sizes in falling order), but for what its repeated blocks cost.

    adds: what each code adds to the next one's contexts, in the end what nothing adds. rest: what a token of each code costs after its bits.
    What the decisions of some tokens are is laid out ahead; then the texts go on token by token, all decisions of a token
    at once: no two of them share a table's slot, but for own slots of a word's bits (twins), and weights learn once a token.
    """
    n = len(starts)
    total, lanes, every = np.zeros(n), Lanes(n, model), np.arange(n, dtype=np.int32)
    history = History(*(np.zeros(len(e.code), t) for t in (np.uint8, np.uint8, bool, bool, np.uint8)))
    edges = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // (1 << 18), prepend=-1))
    for a, b in zip(edges, np.append(edges[1:], n)):  # texts of some hundred thousand tokens at a time
        text = np.repeat(np.arange(b - a, dtype=np.int32), sizes[a:b])
        at = np.arange(len(text)) + np.repeat(starts[a:b] - (np.cumsum(sizes[a:b]) - sizes[a:b]), sizes[a:b])
        part = History.of(Events(e.code[at], e.asked[at], e.before[at], e.pair[at]), text)
        for name in ("repeats", "news", "guessed", "hit", "run"):
            getattr(history, name)[at] = getattr(part, name)
    t = 0
    while n and t < sizes[0]:
        live = int(np.searchsorted(-sizes, -t))
        span = 1 if t < STEADY else AHEAD  # tokens that a text learns from together
        ahead = min(max(span, min(GATHERED, WINDOW // max(1, live))), max(span, STEADY - t) if t < STEADY else span)
        places = t + np.arange(ahead)
        here = places[:, None] < sizes[None, :live]
        lane, at = np.broadcast_to(every[:live], here.shape)[here], (starts[None, :live] + places[:, None])[here]
        step = np.repeat(np.arange(ahead) // span, here.sum(axis=1))
        t, steps = t + ahead, -(-ahead // span)
        code, asked, previous, base = e.code[at], e.asked[at], adds[e.before[at]], lane * WIDTH + (NODES + OWN_SLOTS)
        kinds = []  # which tokens, the bit, the contexts of each decision on whole tokens
        some = np.flatnonzero(asked)
        kinds.append((some, asked[some] == 2, history.repeats[at[some]], history.news[at[some]]))
        some = np.flatnonzero(history.guessed[at])
        kinds.append((some, history.hit[at[some]], history.run[at[some]], previous[some] >> 8 & 15))
        miss = np.flatnonzero((asked != 2) & ~history.hit[at])
        kinds.append((miss, unknown[code[miss]], previous[miss] >> 8 & 15, previous[miss] >> 12 & 15))
        known = miss[~unknown[code[miss]]]
        bits, low, high, node, own, twin = _code_decisions(lane[known], symbol[code[known]], previous[known], lanes)

        # Decisions by step, then by kind or bit, then by lane.
        tokens = [k[0] for k in kinds] + [known] * BITS
        counts = np.array([np.bincount(step[s], minlength=steps) for s in (*tokens[:KINDS], known)])
        counts = np.concatenate([counts[:KINDS], np.repeat(counts[KINDS:], BITS, axis=0)]).T
        begins = (np.cumsum(counts) - counts.reshape(-1)).reshape(counts.shape)
        m = int(counts.sum())
        x, bit, slot = np.zeros((4, m), np.float32), np.empty(m, np.int32), np.empty((2, m), np.int32)
        row, owner = np.empty(m, np.int32), np.empty(m, np.int32)
        spots = []
        for j, some in enumerate(tokens):
            own_first = np.cumsum(counts[:, j]) - counts[:, j]
            to = np.arange(len(some)) + (begins[:, j] - own_first)[step[some]]
            spots.append(to)
            owner[to] = lane[some]
            row[to] = lane[some] * (KINDS + 2) + (j if j < KINDS else KINDS + (j - KINDS >= ENDING_BITS))
            if j < KINDS:
                _, bit[to], first, second = kinds[j]
                x[0, to], slot[0, to], slot[1, to] = lanes.kinds[j], base[some] + j * KIND_SLOTS + first, base[some] + (j * KIND_SLOTS + 16) + second
            else:
                d = j - KINDS
                bit[to], x[0, to], x[1, to], slot[0, to], slot[1, to] = bits[d], low[d], high[d], node[d], own[d]
        pairs = [(spots[KINDS + d][w], np.array([spots[KINDS + c][i] for c, i in zip(twin[d][w], w)], np.int64)) for d in range(1, BITS) if len(w := np.flatnonzero(twin[d] >= 0))]
        later, sooner = (np.concatenate(c) for c in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2
        by_place = np.argsort(later)
        later, sooner = later[by_place], sooner[by_place]
        ends = np.append(begins[:, 0], m)
        twins = np.searchsorted(later, ends)

        mixed_all = np.empty(m, np.float32)
        for i in range(steps):
            a, b, words = ends[i], ends[i + 1], counts[i, -1]
            if a == b:
                continue
            at, full, xs, rows = slot[:, a:b], bit[a:b] * 65535, x[:, a:b], row[a:b]
            p = lanes.table.take(at)
            if twins[i] < twins[i + 1]:
                l, s = later[twins[i] : twins[i + 1]] - a, sooner[twins[i] : twins[i + 1]] - a
                for _ in range(BITS):  # a chain of twins
                    seen = p[1, s] + ((full[s] - p[1, s]) >> SHIFTS[1])
                    if (p[1, l] == seen).all():
                        break
                    p[1, l] = seen
            xs[2:] = _STRETCH.take(p >> 4)
            p += (full - p) >> _SHIFTS
            lanes.table[at[0]], lanes.table[at[1]] = p
            mixed = np.einsum("kd,kd->d", lanes.weights.take(rows, axis=1), xs)
            np.minimum(np.maximum(mixed, -MOST_LOGIT, out=mixed), MOST_LOGIT, out=mixed)
            mixed_all[a:b] = mixed
            slope = xs * (np.float32(WEIGHT_RATE) * (bit[a:b] - 1 / (1 + np.exp(-mixed))))
            whole = b - a - BITS * words
            if whole:
                lanes.weights[:, rows[:whole]] += slope[:, :whole]
            if words:
                slope = slope[:, whole:].reshape(4, BITS, words)
                lanes.weights[:, rows[whole : whole + words]] += slope[:, :ENDING_BITS].sum(axis=1)
                lanes.weights[:, rows[-words:]] += slope[:, ENDING_BITS:].sum(axis=1)
        if m:
            q = _sigmoid(mixed_all.astype(float))
            q += REFINE_SHARE * (lanes.refined(owner, mixed_all, bit) - q)
            total += np.bincount(owner, weights=-np.log2(np.where(bit > 0, q, 1 - q)), minlength=n)
        total += np.bincount(lane[miss], weights=rest[code[miss]], minlength=n)
    return total


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"


def score_chunk(model: Model, docs: pa.Table, rows: pa.Table) -> pa.Table:
    """Scores of a chunk's documents; rows: its dictionary (chunk, code, c, word, mark), with the word where c is 0; blocks have no mark."""
    is_word = rows.column("mark").is_valid().to_numpy(zero_copy_only=False)
    at_word, at_gram = np.flatnonzero(is_word), np.flatnonzero(~is_word)
    all_codes, all_counts = rows.column("code").to_numpy(), rows.column("c").to_numpy()
    order = at_word[np.argsort(all_codes[at_word])]
    counts = all_counts[order]
    grams = np.zeros(len(at_gram), np.int64)
    grams[all_codes[at_gram]] = all_counts[at_gram]
    marks = pc.fill_null(rows.column("mark"), 0).to_numpy()[order]
    base = np.log10((counts + 1) / (model.tokens + model.distinct + 1))
    unknown, symbol = counts == 0, (marks >> 16).astype(np.int64)
    rest = np.log2(np.maximum(model.masses[symbol], 1) / np.maximum(counts, 1))
    rest[unknown] = model.spelled([w.encode() for w in rows.column("word").take(pa.array(order[unknown])).to_pylist()])

    codes, sizes = _runs(docs.column("codes"))
    triples, n_blocks = _runs(docs.column("blocks"))
    held = docs.column("held_out").to_numpy(zero_copy_only=False)
    first = np.cumsum(sizes) - sizes
    # A block counts without the text that it stands in, if that is one of the training documents.
    start, length, gram = triples.reshape(-1, 3).astype(np.int64).T
    of = np.repeat(np.arange(len(sizes)), n_blocks // 3)
    _, inverse, times = np.unique(of * max(1, len(grams)) + gram, return_inverse=True, return_counts=True)
    others = grams[gram] - np.where(held[of], 0, times[inverse])
    repeats = others > 0
    start = first[of] + start
    asked = np.zeros(len(codes), np.uint8)
    asked[start] = 1 + repeats
    bits = np.bincount(of[repeats], weights=np.log2(max(model.blocks, 1) / others[repeats]), minlength=len(sizes)).astype(float)
    gone = np.zeros(len(codes) + 1, np.int8)
    np.add.at(gone, start[repeats] + 1, 1)
    np.add.at(gone, (start + length)[repeats], -1)
    kept = np.flatnonzero(np.cumsum(gone, dtype=np.int8)[:-1] == 0).astype(np.int32)

    adds = np.append(before(marks), 0)  # the last one where no word comes before
    one = np.concatenate([[-1], codes[:-1]]).astype(np.int32)
    two = np.concatenate([[-1, -1], codes[:-2]])[: len(codes)].astype(np.int32)
    one[first], two[first] = -1, -1
    two[(first + 1)[sizes > 1]] = -1
    pair = np.empty(len(kept), np.int16)
    for at in range(0, len(kept), 1 << 18):
        some = kept[at : at + (1 << 18)]
        pair[at : at + len(some)] = (3 * adds[one[some]] + 5 * adds[two[some]]) >> 17 & (FOLLOW_SLOTS - 1)
    events = Events(codes[kept], asked[kept], one[kept], pair)
    del one, two, pair
    left = np.diff(np.searchsorted(kept, np.append(first, len(codes))))
    begins = np.cumsum(left) - left
    long_first = np.argsort(-left, kind="stable")
    for at in range(0, len(left), LANES):
        part = long_first[at : at + LANES]
        bits[part] += stream_costs(events, symbol, adds, unknown, rest, model, begins[part], left[part])
    n_bytes = docs.column("n_bytes").to_numpy()
    per_byte = np.where(n_bytes > 0, bits / np.maximum(n_bytes, 1), np.nan)
    sums = lambda values: np.add.reduceat(values[codes], first)  # noqa: E731  (each text has its end at least)
    return pa.table(
        {
            "doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"), "n_tokens": pa.array(sizes), "n_known": pa.array(sums((counts > 0).astype(np.int64))),
            "train_tokens": pa.array(np.full(len(sizes), model.tokens)), "base_score": pa.array(sums(base)), "score": pa.array(-bits * np.log10(2)), "bits_per_byte": pa.array(per_byte, from_pandas=True),
        }
    )


def score_documents(docs: DataFrame) -> DataFrame:
    """Scores of all rows of (doc_id, text), learned from those whose id isn't held out."""
    spark = docs.sparkSession
    chunks = materialise(chunked(docs), "scoring-chunks")
    rows = chunks.where("cid is not null and codes is null").select("cid", "word", "gram", "code", "mark", "n_train")
    kept = F.when(F.col("first") | (F.col("c") == 0), F.col("word"))
    words = materialise(counted(rows).select("cid", "code", "c", "first", kept.alias("word"), "mark"), "scoring-words")

    known = words.where("first and mark is not null and c > 0")
    by_symbol = known.groupBy(F.shiftright("mark", 16).alias("k")).agg(F.sum("c").alias("c"), F.count("*").alias("v"), F.count_if(F.col("c") == 1).alias("ones")).collect()  # at most NODES rows
    masses = np.zeros(NODES, np.int64)
    for r in by_symbol:
        masses[r["k"]] = r["c"]
    blocks = words.where("first and mark is null").agg(F.sum("c")).first()[0] or 0

    def table(bits: pa.Table, size: int) -> np.ndarray:  # a fixed size, whatever the corpus
        out = np.zeros((2, size), np.int32)
        for row, name in enumerate(("zeros", "ones")):
            out[row, bits.column("slot").to_numpy()] = np.minimum(bits.column(name).to_numpy(), 2**31 - 1)
        return out

    sums = F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones")
    contexts = chunks.where("ones is not null").select(F.col("code").alias("slot"), F.col("n_train").alias("zeros"), "ones").groupBy("slot").agg(*sums).toArrow()
    spell = known.where("word <> ''").select("word").mapInArrow(spelling_counts, "slot long, zeros long, ones long").groupBy("slot").agg(*sums).toArrow()
    n, v, singles = (sum(r[c] for r in by_symbol) for c in ("c", "v", "ones"))
    model = spark.sparkContext.broadcast(Model(n, v, singles, blocks, masses, table(contexts, CORPUS_SLOTS), table(spell, SPELL_STARTS[-1])))

    # Partitions grow with the number of chunks, so that a task's input doesn't grow with the corpus.
    texts = chunks.where("codes is not null").select("cid", "doc_id", "held_out", "n_bytes", "codes", "blocks")
    parts = max(1, 4 * texts.select("cid").distinct().count())
    dictionary = words.select(F.col("cid").alias("chunk"), "code", "c", F.when(F.col("c") == 0, F.col("word")).alias("word"), "mark")

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        give_back()
        return score_chunk(model.value, left, right)

    return texts.repartition(parts, "cid").groupBy("cid").cogroup(dictionary.repartition(parts, "chunk").groupBy("chunk")).applyInArrow(score, SCORES)


def op4_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read_table(spark, sf_dir, "documents"))


QUERIES = {"op4_scoring": op4_scoring}
ORACLES: dict[str, str] = {}
