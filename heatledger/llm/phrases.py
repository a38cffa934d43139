"""Collocations by growing contiguous patterns to the right from projected occurrences.

Texts become blocks of word codes with a dictionary each, written once. Counts of (lang, word) over all dictionaries tell which words are
frequent; these get a number, which a join by (block, word) brings back to the blocks, one row for each block that has the word. A block then projects its
occurrences: for each two frequent words in a row, the first word, which is the prefix, points at the frequent words that follow it, up to the longest phrase. Equal
pointers of a block are one with a count. Each prefix goes to one task, which grows it depth first: it counts the next words among the prefix's
pointers, and goes on with the pointers of those that are frequent; what is rare is not grown, as no longer phrase can be more frequent.

A prefix of more than ``split_at`` occurrences is dealt over as many tasks as it exceeds that number by, by all words that follow, so its longest phrases
are still whole in one task; the counts of its shorter ones are partial there, kept however small, and added up afterwards. Pointers are packed for each part that a
block has pointers for. A part holds some ``split_at`` occurrences and no more rows than that of any prefix, so hot words and hot pairs make no task large.

A phrase's cuts are joined to the counts of both sides, in decimals of 38 digits, and ranks are taken in three levels of tasks, each of which keeps the
first ``top`` of a language.

Defined results: null text has no words, null lang is ``und``, ids are not read: rows that repeat count each. Words stay as they are but for A-Z. A language without candidates has no row;
an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heatledger.llm.blocks import pack_counts, unpack_counts
from heatledger.llm.common import as_bytes, batches, discard, materialise, read_table

BREAK = b"\xff"
#: A-Z to a-z, tab to space, ends of pieces to a byte that no UTF-8 text has.
TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + BREAK * 10)
CODED = pa.schema([("block", pa.int64()), ("own", pa.int32()), ("data", pa.binary()), ("local", pa.int32()), ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])
CODED_DDL = "block long, own int, data binary, local int, lang string, word string, n long"
POINTERS_DDL = "part int, data binary"
#: Frequent words are numbered in so many shares, the commonest of each first.
SHARES = 4096
#: Levels of the ranking: tasks for each language.
LEVELS = (1024, 32, 1)


class Codes(dict):
    """Codes of one language's words in a block, new ones as they come; a break is 0."""

    def __init__(self, lang: str, words: list):
        super().__init__({BREAK: 0})
        self.lang, self.words = lang, words

    def __missing__(self, word: bytes) -> int:
        self.words.append((self.lang, word))
        code = self[word] = len(self.words)
        return code


class Coder:
    """A block being filled: codes so far, whose words are in ``words`` from code 1 on."""

    def __init__(self):
        self.words, self.by_lang, self.codes, self.size = [], {}, [], 0

    def add(self, lang: str, tokens: list, size: int) -> None:
        table = self.by_lang.get(lang)
        if table is None:
            table = self.by_lang[lang] = Codes(lang, self.words)
        self.codes.append(np.fromiter(map(table.__getitem__, tokens), np.int32, len(tokens)))
        self.size += size

    def rows(self, block: int, ahead: int):
        """The block's row and those of its words; the last ``ahead`` codes only follow others, they count in the next block."""
        codes = np.concatenate(self.codes)
        own = len(codes) - ahead
        counts = np.bincount(codes[:own], minlength=len(self.words) + 1)[1:]
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((block, own, zstandard.compress(codes.tobytes(), 3), None, None, None, None), CODED, strict=True)], schema=CODED)
        for at in range(0, len(self.words), 1 << 16):
            some = self.words[at : at + (1 << 16)]
            n = len(some)
            columns = [np.full(n, block), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), np.arange(at + 1, at + n + 1, dtype=np.int32), [x for x, _ in some], pa.array([w for _, w in some], pa.binary()).cast(pa.string()), counts[at : at + n]]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, CODED, strict=True)], schema=CODED)


def slices(text: bytes, limit: int):
    """Tokens of a text, breaks among them, as lists of some ``limit`` bytes each, with their size."""
    text = text.translate(TABLE).replace(BREAK, b" " + BREAK + b" ")
    at = 0
    while at < len(text):
        to = text.find(b" ", at + limit) if at + limit < len(text) else -1
        to = len(text) if to < 0 else to
        yield text[at:to].split(), to - at
        at = to


def _encode(block_bytes: int, longest: int):
    """Rows of ``CODED`` of rows (lang, text)."""

    def run(items):
        base, k, coder = TaskContext.get().partitionId() << 34, 0, Coder()
        for b in batches(items):
            for lang, text in zip(b.column(0).to_pylist(), as_bytes(b.column(1)), strict=True):
                for tokens, size in slices(text, block_bytes):
                    coder.add(lang, tokens, size)
                    if coder.size >= block_bytes:
                        tail = np.concatenate(coder.codes)[1 - longest :].tolist()
                        since = max((i + 1 for i, c in enumerate(tail) if c == 0), default=0)
                        rest = [coder.words[c - 1][1] for c in tail[since:]]
                        ahead = len(rest)
                        yield from coder.rows(base + k, ahead)
                        k, coder = k + 1, Coder()
                        coder.add(lang, rest, 0)
                coder.add(lang, [BREAK], 1)
        if coder.words:
            yield from coder.rows(base + k, 0)

    return run


def tally(columns: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of non-negative columns in order, and how often each occurs or the sum of its counts."""
    n = len(columns[0])
    if not n:
        return columns, np.zeros(0, np.int64)
    bits = max(1, int(max(c.max() for c in columns)).bit_length())
    if bits * len(columns) < 64:
        key = np.zeros(n, np.int64)
        for c in columns:
            key = (key << bits) | c
        order = None
        if counts is None:
            key.sort()
        else:
            order = np.argsort(key)
            key = key[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        key = key[first]
        mask = (1 << bits) - 1
        out = [(key >> (bits * (len(columns) - 1 - i))) & mask for i in range(len(columns))]
    else:
        order = np.lexsort(columns[::-1])
        ordered = [c[order] for c in columns]
        new = np.zeros(n, bool)
        new[0] = True
        for c in ordered:
            new[1:] |= c[1:] != c[:-1]
        first = np.flatnonzero(new)
        out = [c[first] for c in ordered]
    if counts is None:
        return out, np.diff(np.append(first, n))
    return out, np.add.reduceat(counts[order], first)


def scattered(x: np.ndarray) -> np.ndarray:
    """Numbers mixed so that their remainders are even."""
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    return (x * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(20)


def pack(columns: list[np.ndarray], split: np.ndarray, counts: np.ndarray) -> bytes:
    """Pointers in few bytes: the planes of their bytes, whether their prefix is split, counts."""
    width = max(1, -(-int(max(c.max() for c in columns)).bit_length() // 8))
    planes = [np.ascontiguousarray(c.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes() for c in columns]
    head = np.array([len(counts), len(columns), width], "<i8").tobytes()
    return zstandard.compress(head + b"".join(planes) + split.astype(np.uint8).tobytes() + pack_counts(counts), 1)


def unpack(data: bytes) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    data = zstandard.decompress(data)
    n, k, width = np.frombuffer(data, "<i8", 3).tolist()
    at, columns = 24, []
    for _ in range(k):
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n).T
        columns.append(wide.reshape(-1).view("<i8"))
        at += n * width
    return columns, np.frombuffer(data, np.uint8, n, at).astype(bool), unpack_counts(data[at + n :])


def pointers(seq: np.ndarray, total: np.ndarray, own: int, longest: int, parts: int, split_at: int):
    """Rows (part, packed) of a block's words ``seq``, 0 where none is frequent; ``total`` holds the count of each."""
    seq = np.concatenate((seq, np.zeros(longest, np.int64)))
    heads = np.flatnonzero((seq[:own] > 0) & (seq[1 : own + 1] > 0))
    if not len(heads):
        return
    columns = [seq[heads], seq[heads + 1]]
    for j in range(2, longest):
        columns.append(np.where(columns[-1] > 0, seq[heads + j], 0))
    columns, counts = tally(columns)
    # the count of each distinct prefix, by its first place in the block
    number, where = np.unique(seq[heads], return_index=True)
    size = total[heads[where]][np.searchsorted(number, columns[0])]
    share = -(-size // split_at)
    part = scattered(columns[0]) % np.uint64(parts)
    rest = np.zeros(len(part), np.uint64)
    for c in columns[1:]:
        rest = scattered(rest ^ c.astype(np.uint64)) + c.astype(np.uint64)
    part = ((part + scattered(rest) % share.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    part, columns, counts, split = part[order], [c[order] for c in columns], counts[order], (share > 1)[order]
    cuts = np.append(np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))), len(part)).tolist()
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield int(part[a]), pack([c[a:b] for c in columns], split[a:b], counts[a:b])


def _project(longest: int, parts: int, split_at: int):
    """Rows of ``POINTERS_DDL`` of blocks (own, data, told)."""

    def run(items):
        for b in batches(items):
            for i in range(b.num_rows):
                told = b.column(2)[i]
                if not told.is_valid:
                    continue
                local, number, total = (told.values.field(j).to_numpy(zero_copy_only=False) for j in range(3))
                codes = np.frombuffer(zstandard.decompress(b.column(1)[i].as_py()), np.int32)
                ids, counts = np.zeros(max(int(codes.max()), int(local.max())) + 1, np.int64), None
                ids[local] = number
                counts = np.zeros_like(ids)
                counts[local] = total
                rows = list(pointers(ids[codes], counts[codes], b.column(0)[i].as_py(), longest, parts, split_at))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["part", "data"])

    return run


def grow(columns: list[np.ndarray], split: np.ndarray, counts: np.ndarray, least: int):
    """Phrases (words, count) of sorted pointers, depth first; of a split prefix all but the longest are partial and kept however rare."""
    longest = len(columns)
    stack = [(0, len(counts), 0, False)] if len(counts) else []
    while stack:
        low, high, depth, partial = stack.pop()
        word = columns[depth][low:high]
        starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        sums = np.add.reduceat(counts[low:high], starts)
        ends = np.append(starts[1:], high - low)
        keep = word[starts] > 0
        if depth:
            last = depth + 1 == longest
            keep &= (sums >= least) | (partial and not last)
        for s, e, n in zip((low + starts[keep]).tolist(), (low + ends[keep]).tolist(), sums[keep].tolist(), strict=True):
            if depth:
                yield [int(c[s]) for c in columns[: depth + 1]], n
            if depth + 1 < longest:
                stack.append((s, e, depth + 1, partial or (depth == 0 and bool(split[s]))))


def _grow(least: int):
    def run(key, table):
        each = [unpack(x) for x in table.column("data").to_pylist()]
        columns = [np.concatenate([e[0][j] for e in each]) for j in range(len(each[0][0]))]
        split = np.concatenate([e[1] for e in each])
        hot = np.unique(columns[0][split])
        columns, counts = tally(columns, np.concatenate([e[2] for e in each]))
        found = list(grow(columns, np.isin(columns[0], hot), counts, least))
        return pa.table({"ids": pa.array([f[0] for f in found], pa.list_(pa.int64())), "n": pa.array([f[1] for f in found], pa.int64())})

    return run


def frequent_words(coded: DataFrame, least: int) -> DataFrame:
    """Rows (id, lang, word, f): the words with at least ``least`` occurrences, numbered from 1."""
    counted = coded.filter("local IS NOT NULL").groupBy("lang", "word").agg(F.sum("n").alias("f")).filter(F.col("f") >= least)
    shared = counted.withColumn("share", F.pmod(F.xxhash64("lang", "word"), F.lit(SHARES)))
    place = F.row_number().over(Window.partitionBy("share").orderBy(F.desc("f"), "lang", "word")) - 1
    return shared.select((place.cast("long") * SHARES + F.col("share") + 1).alias("id"), "lang", "word", "f")


def frequent_phrases(coded: DataFrame, words: DataFrame, least: int, longest: int, split_at: int) -> DataFrame:
    """Rows (ids, a): word numbers and count of each phrase of 2 to ``longest`` words with at least ``least`` occurrences."""
    known = coded.filter("local IS NOT NULL").select("block", "local", "lang", "word").join(words, ["lang", "word"])
    told = known.groupBy(F.col("block").alias("told_block")).agg(F.collect_list(F.struct("local", "id", "f")).alias("told"))
    blocks = coded.filter("data IS NOT NULL").select("block", "own", "data").join(told, F.col("block") == F.col("told_block"), "left").select("own", "data", "told")
    size = words.agg(F.sum("f").alias("n")).first().n or 0
    parts = int(min(size // split_at + 1, (1 << 31) - 1))
    grown = blocks.mapInArrow(_project(longest, parts, split_at), POINTERS_DDL).groupBy("part").applyInArrow(_grow(least), "ids array<long>, n long")
    return grown.groupBy("ids").agg(F.sum("n").alias("a")).filter(F.col("a") >= least)


def scored(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """Rows (ids, a, l, r, score) of each phrase by its lowest-scoring cut."""
    counts = words.select(F.array("id").alias("key"), F.col("f").alias("count")).unionByName(phrases.select(F.col("ids").alias("key"), F.col("a").alias("count")))
    cuts = phrases.select("ids", "a", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    cuts = cuts.select("ids", "a", "k", F.slice("ids", F.lit(1), F.col("k")).alias("left"), F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")).alias("right"))
    cuts = cuts.join(counts.select(F.col("key").alias("left"), F.col("count").alias("l")), "left").join(counts.select(F.col("key").alias("right"), F.col("count").alias("r")), "right")
    wide = {c: f"CAST({c} AS DECIMAL(15, 0))" for c in ("a", "l", "r")}
    score = F.expr(f"(1000000BD * {wide['a']} * {wide['a']}) div ({wide['l']} * {wide['r']})")
    best = cuts.withColumn("score", score).groupBy("ids").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("ids", "a", "cut.l", "cut.r", "cut.score")


def maximal(candidates: DataFrame, phrases: DataFrame, percent: int) -> DataFrame:
    """Candidates that no longer phrase with ``percent`` of their occurrences contains."""
    at = F.flatten(F.transform(F.sequence(F.lit(2), F.size("ids") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.size("ids") - n + 1), lambda i: F.slice("ids", i, n))))
    inner = phrases.filter(F.size("ids") > 2).select(F.explode(at).alias("ids"), "a").groupBy("ids").agg(F.max("a").alias("longer"))
    return candidates.join(inner, "ids", "left").filter(F.coalesce(100 * F.col("longer") < percent * F.col("a"), F.lit(True))).drop("longer")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 10, longest: int = 3, percent: int = 50, top: int = 2000, block_bytes: int = 16 << 20, split_at: int = 1 << 21) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of 2 to ``longest`` words."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    coded = materialise(rows.mapInArrow(_encode(block_bytes, longest), CODED_DDL), "phrase-blocks")
    words = materialise(frequent_words(coded, least), "phrase-words")
    phrases = materialise(frequent_phrases(coded, words, least, longest, split_at), "phrases")
    n = materialise(coded.filter("local IS NOT NULL").groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    discard(coded)
    kept = maximal(scored(phrases, words), phrases, percent)
    spelled = kept.select("*", F.posexplode("ids").alias("pos", "id")).join(words.select("id", "lang", "word"), "id")
    spelled = spelled.groupBy("ids").agg(*[F.first(c).alias(c) for c in ("lang", "a", "l", "r", "score")], F.sort_array(F.collect_list(F.struct("pos", "word"))).alias("words"))
    ranked = spelled.select("lang", F.concat_ws(" ", F.col("words.word")).alias("phrase"), "a", "l", "r", "score", F.xxhash64("ids").alias("h"))
    for level in LEVELS:
        w = Window.partitionBy("lang", F.pmod("h", F.lit(level))).orderBy(F.desc("score"), F.desc("a"), "phrase")
        ranked = ranked.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark, sf_dir: str) -> DataFrame:
    """Whole ``documents``: the columns of ``collocations``."""
    return collocations(read_table(spark, sf_dir, "documents"))


#: The same rows in DuckDB.
ORACLE = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \x09]+'), lambda x: x <> '') AS ws FROM p),
f1 AS (SELECT lang, x AS a1, count(*) AS f FROM (SELECT lang, unnest(ws) AS x FROM w) GROUP BY ALL),
f2 AS (SELECT lang, ws[i] AS a1, ws[i + 1] AS a2, count(*) AS f FROM (SELECT lang, ws, unnest(range(1, len(ws))) AS i FROM w) GROUP BY ALL HAVING count(*) >= 10),
f3 AS (SELECT lang, ws[i] AS a1, ws[i + 1] AS a2, ws[i + 2] AS a3, count(*) AS f FROM (SELECT lang, ws, unnest(range(1, len(ws) - 1)) AS i FROM w) GROUP BY ALL HAVING count(*) >= 10),
t AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang),
c AS (SELECT f2.lang, f2.a1 || ' ' || f2.a2 AS phrase, 1 AS k, f2.f AS a, x.f AS l, y.f AS r FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.a1 = f2.a1 JOIN f1 y ON y.lang = f2.lang AND y.a1 = f2.a2
 UNION ALL SELECT f3.lang, f3.a1 || ' ' || f3.a2 || ' ' || f3.a3, 1, f3.f, x.f, y.f FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.a1 = f3.a1 JOIN f2 y ON y.lang = f3.lang AND y.a1 = f3.a2 AND y.a2 = f3.a3
 UNION ALL SELECT f3.lang, f3.a1 || ' ' || f3.a2 || ' ' || f3.a3, 2, f3.f, x.f, y.f FROM f3 JOIN f2 x ON x.lang = f3.lang AND x.a1 = f3.a1 AND x.a2 = f3.a2 JOIN f1 y ON y.lang = f3.lang AND y.a1 = f3.a3),
s AS (SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM c),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (SELECT lang, phrase, max(f) AS longer FROM (SELECT lang, a1 || ' ' || a2 AS phrase, f FROM f3 UNION ALL SELECT lang, a2 || ' ' || a3, f FROM f3) GROUP BY ALL),
g AS (SELECT b.lang, b.phrase, b.a, b.l, b.r, b.score, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank FROM b LEFT JOIN i ON i.lang = b.lang AND i.phrase = b.phrase WHERE i.longer IS NULL OR 100 * i.longer < 50 * b.a)
SELECT g.lang, g.rank, g.phrase, g.a, g.l, g.r, t.n, g.score FROM g JOIN t ON t.lang = g.lang WHERE g.rank <= 2000
"""
