"""Language-model scoring with a weighted backoff automaton over word trigrams.

States are histories seen in training: pairs of words, single words (the start of a text is one of them) and the empty
history. An n-gram seen in training is an arc from its history, with the smoothed log-probability as weight, to the longest
history that ends with its word. Every other state has a failure arc to the history that is shorter by the oldest word, to be taken, without reading, where no
arc reads the next word. Smoothing is by hierarchical Dirichlet priors: p(w) = (c(w) + 1) / (N + V + 1), the arc of w from history h weighs
(c(h w) + K p(w | shorter h)) / (c(h) + K) and the failure arc K / (c(h) + K), so the weights of a state,
followed to the end, sum to one over the words and the unknown word. A text is walked once from left to right, the state carried
along, the weights of all arcs taken added up.

The automaton grows with the corpus and is nowhere whole. Each block of texts counts its n-grams and learns
their totals over all blocks, as ``blocks`` describes; then it has every state and arc its texts can meet. A block walks all its texts side by
side, word by word. Texts of more than ``piece_bytes`` are cut after words; a piece comes with the two words before it,
which bring the walk to the state it had, and the sums of a text's pieces are added up at the end.

Defined results: null text is empty and has the end token alone; a null id is never held out; rows that repeat
an id are scored each and, when training, counted each; without training rows all counts are zero;
an empty table gives an empty result; only named columns are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatledger.llm.blocks import SENT, SENT_DDL, answer, batch_of, bundle, messages, tallied, totals, unpack_table, with_answers
from heatledger.llm.common import batches, discard, materialise

#: Key of the end of a text, which as a history is the start of one.
END = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)
SPACE = re.compile(rb"[\x20\x09-\x0d]")
#: A piece of a text: the row it belongs to, words in front that are context only, whether it starts where the text does but for these, whether it ends the text.
PIECE = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("skip", pa.int32()), ("start", pa.bool_()), ("last", pa.bool_()), ("text", pa.binary())])
SUMS = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("n_failures", pa.int64())])
SUMS_DDL = "row long, doc_id long, n_tokens long, n_known long, base_score double, score double, n_failures long"


class WordKeys(dict):
    """64-bit key of each word; forgotten and computed anew once ``MEMORY`` words are held."""

    MEMORY = 1 << 18

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.MEMORY:
            self.clear()
        key = xxhash.xxh3_64_intdigest(word)
        self[word] = key
        return key


def held_out(doc_id: int | None) -> bool:
    """Whether crc32 of the id as text leaves 2 when divided by 7."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def cut_pieces(piece_bytes: int):
    """Pieces of a text (doc_id, text), as rows of ``PIECE``."""

    def cut(row, fields):
        doc_id, text = fields
        at, context, start = 0, [], True
        while True:
            found = SPACE.search(text, at + piece_bytes)
            to = found.start() if found else len(text)
            own = text[at:to]
            yield row, doc_id, len(context), start, to == len(text), b" ".join([*context, own])
            if to == len(text):
                return
            words = [*context, *own.split()]
            start = start and len(words) < 2
            at, context = to, words[-2:]

    return cut


class Lanes(NamedTuple):
    """Tokens of a block's pieces, a piece after the other, with the places of their n-grams among the distinct ones.

    ``distinct`` holds for each order the distinct keys and their counts in the block's own training texts, ``places`` for each
    token its n-gram of each order, -1 where the piece does not show its history.
    """

    offsets: np.ndarray
    skip: np.ndarray
    start: np.ndarray
    distinct: dict[int, tuple[np.ndarray, np.ndarray]]
    places: dict[int, np.ndarray]


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    pair = (a ^ (b >> np.uint64(29))) * MIX + b
    pair ^= pair >> np.uint64(32)
    return pair * MIX


def lanes_of(pieces: pa.Table, orders: Iterable[int] = range(3)) -> Lanes:
    """The lanes of a block's pieces, with the n-grams of the given orders only, counted from 0."""
    keys = WordKeys()
    parts, offsets = [], [0]
    for text, last in zip(pieces.column("text").to_pylist(), pieces.column("last").to_pylist(), strict=True):
        words = text.lower().split()
        own = np.empty(len(words) + last, np.uint64)
        own[: len(words)] = np.fromiter(map(keys.__getitem__, words), np.uint64, len(words))
        own[len(words) :] = END
        parts.append(own)
        offsets.append(offsets[-1] + len(own))
    tokens, offsets = np.concatenate(parts), np.array(offsets)
    del keys, parts  # the words are not needed from here on
    n = np.diff(offsets)
    skip = pieces.column("skip").to_numpy().astype(np.int64)
    start = pieces.column("start").to_numpy(zero_copy_only=False)
    train = np.array([not held_out(d) for d in pieces.column("doc_id").to_pylist()], bool)
    within = np.arange(len(tokens), dtype=np.int32) - np.repeat(offsets[:-1].astype(np.int32), n)
    learn = np.repeat(train, n) & (within >= np.repeat(skip.astype(np.int32), n))
    distinct, places = {}, {}
    before = np.concatenate((tokens[-1:], tokens[:-1]))
    before[within == 0] = END  # the start of a text; of other pieces this place is left out
    bigrams = mixed(before, tokens)
    del before
    for order in orders:
        grams = (tokens, bigrams)[order] if order < 2 else mixed(np.concatenate((bigrams[-1:], bigrams[:-1])), tokens)
        # with the start in view one word less is needed; the start itself has no history
        at = np.flatnonzero(within >= np.repeat(np.where(start, max(0, order - 1), order).astype(np.int32), n))
        # the end is among a block's words even if no piece shows it, as its count is that of the start as a history
        extra = 1 if order == 0 else 0
        key, count, place = tallied(np.append(grams, END) if extra else grams[at], np.append(learn, False) if extra else learn[at])
        del grams
        own = np.full(len(tokens), -1, np.int32)
        own[at] = place[: len(at)]
        distinct[order] = key, count
        places[order] = own
    return Lanes(offsets, skip, start, distinct, places)


class Automaton(NamedTuple):
    """States and arcs a block can meet: state 0 is the empty history, then come words, then pairs.

    ``arcs`` holds for each order the log10 weight of each n-gram, NaN where training lacks it and so no arc is;
    ``fail`` the weight of each state's failure arc; ``known`` whether a state exists.
    """

    arcs: list[np.ndarray]
    fail: np.ndarray
    known: np.ndarray
    n_words: int


def automaton(lanes: Lanes, counts: list[np.ndarray], n_train: int, n_types: int, prior: float) -> Automaton:
    """The automaton of the totals ``counts`` of each order's distinct n-grams."""
    words, pairs, triples = counts
    p1 = (words + 1.0) / (n_train + n_types + 1.0)
    last = [np.zeros(len(c), np.int32) for c in counts]  # for each n-gram that of the next order down it ends with
    history = [np.zeros(len(c), np.int32) for c in counts]  # and the one it begins with
    u, b, t = (lanes.places[order] for order in range(3))
    end = np.searchsorted(lanes.distinct[0][0], END)
    has = np.flatnonzero(b >= 0)
    last[1][b[has]] = u[has]
    before = np.where(has > 0, u[has - 1], 0)
    before[np.isin(has, lanes.offsets[:-1])] = end
    history[1][b[has]] = before
    has = np.flatnonzero(t >= 0)
    last[2][t[has]], history[2][t[has]] = b[has], b[has - 1]
    p2 = (pairs + prior * p1[last[1]]) / (words[history[1]] + prior)
    p3 = (triples + prior * p2[last[2]]) / (pairs[history[2]] + prior)
    arcs = [np.log10(p1), np.where(pairs > 0, np.log10(p2), np.nan), np.where(triples > 0, np.log10(p3), np.nan)]
    seen = np.concatenate(([0], words, pairs))
    return Automaton(arcs, np.log10(prior / (seen + prior)), np.concatenate(([True], words > 0, pairs > 0)), len(words))


def walk(lanes: Lanes, machine: Automaton) -> tuple[np.ndarray, np.ndarray]:
    """Score of each piece and the failure arcs it took: one step a word for all pieces that still have one."""
    u, b, t = (lanes.places[order] for order in range(3))
    n = np.diff(lanes.offsets)
    longest_first = np.argsort(-n, kind="stable")
    length, first, skip = n[longest_first], lanes.offsets[:-1][longest_first], lanes.skip[longest_first]
    state = np.where(lanes.start[longest_first], 1 + np.searchsorted(lanes.distinct[0][0], END), 0)
    state = np.where(machine.known[state], state, 0)
    score, failures = np.zeros(len(n)), np.zeros(len(n), np.int64)
    n_words = machine.n_words
    for j in range(int(length[0]) if len(length) else 0):
        m = int(np.searchsorted(-length, -j))
        at, here = first[:m] + j, state[:m]
        weight = np.zeros(m)
        read = np.zeros(m, bool)
        for order in (2, 1, 0):
            low, high = ((0, 1), (1, n_words + 1), (n_words + 1, len(machine.fail)))[order]
            lane = np.flatnonzero(~read & (here >= low) & (here < high))
            if not len(lane):
                continue
            place = at[lane]
            arc = machine.arcs[order][(u, b, t)[order][place]]
            found = ~np.isnan(arc)
            go, stay = lane[found], lane[~found]
            weight[go] += arc[found]
            read[go] = True
            # to the longest history that ends with this word: a pair where the arc came from a word or a pair
            here[go] = 1 + u[place[found]] if order == 0 else 1 + n_words + b[place[found]]
            weight[stay] += machine.fail[here[stay]]
            failures[stay] += j >= skip[stay]
            here[stay] = 1 + u[place[~found] - 1] if order == 2 else 0
        here[~machine.known[here]] = 0
        score[:m] += np.where(j >= skip[:m], weight, 0)
    out = np.empty_like(score)
    out[longest_first] = score
    failed = np.empty_like(failures)
    failed[longest_first] = failures
    return out, failed


def _count(orders: tuple[int, ...], parts: int):
    """Messages about the n-grams of some orders of blocks (block, data)."""

    def run(items):
        for batch in batches(items):
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for order, (keys, counts) in lanes_of(unpack_table(data.as_py()), orders).distinct.items():
                    rows = messages(order, block, keys, counts, parts)
                    if rows:
                        yield batch_of(rows, SENT)

    return run


def _score(n_train: int, n_types: int, prior: float):
    """Sums of each piece of blocks (block, data, told)."""

    def run(items):
        for batch in batches(items):
            for i in range(batch.num_rows):
                pieces = unpack_table(batch.column(1)[i].as_py())
                told = batch.column(2)[i].as_py()
                lanes = lanes_of(pieces)
                counts = [answer(told, order) for order in range(3)]
                score, failures = walk(lanes, automaton(lanes, counts, n_train, n_types, prior))
                n = np.diff(lanes.offsets)
                own = np.arange(len(lanes.places[0])) - np.repeat(lanes.offsets[:-1], n) >= np.repeat(lanes.skip, n)
                count = counts[0][lanes.places[0]]
                sums = [np.concatenate(([0], np.cumsum(np.where(own, x, 0)))) for x in (own, count > 0, np.log10((count + 1.0) / (n_train + n_types + 1.0)))]
                each = [s[lanes.offsets[1:]] - s[lanes.offsets[:-1]] for s in sums]
                columns = [pieces.column("row"), pieces.column("doc_id"), *each, score, failures]
                yield pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else pa.array(c, f.type) for c, f in zip(columns, SUMS, strict=True)], schema=SUMS)

    return run


def score_documents(docs: DataFrame, prior: float = 4.0, block_bytes: int = 4 << 20, piece_bytes: int = 1 << 13) -> DataFrame:
    """A row for each document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_failures."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8").alias("text"))
    blocks = materialise(bundle(rows, cut_pieces(piece_bytes), PIECE, block_bytes), "ngram-blocks")
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    parts = 2 * (int(size // block_bytes) + 1)
    # words and pairs first, then triples, so that only one half of the messages is in the shuffle at a time
    told, more = (materialise(totals(blocks.mapInArrow(_count(orders, parts), SENT_DDL)), "ngram-totals") for orders in ((0, 1), (2,)))
    whole = told.filter("block < 0 AND kind = 0").agg(F.sum("types").alias("types"), F.sum("tokens").alias("tokens")).first()
    n_train, n_types = whole.tokens or 0, whole.types or 0
    sums = materialise(with_answers(blocks, told.unionByName(more)).mapInArrow(_score(n_train, n_types, prior), SUMS_DDL), "ngram-sums")
    discard(blocks, told, more)
    out = sums.groupBy("row").agg(F.first("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score", "n_failures")])
    held = F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 7 == 2, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"), "base_score", "score", "n_failures")


def op5_lm_scoring(spark, sf_dir: str) -> DataFrame:
    """Whole ``documents``: the columns of ``score_documents``."""
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
