"""Quality rules: a linear-chain conditional random field labels lines as content or boilerplate.

Each line of a text that has a word gets a few features (how much of it is capitals, digits, symbols,
exclamation marks; how long it is; whether it repeats an earlier line or its own words; how it ends).
Viterbi decoding gives the likeliest label sequence, and the share of the text's word characters in
content lines decides retention, after two plain rules.

What is labelled is documents, so the labels of lines are latent: a document's label says of each of its lines only that it is
content with probability ``SURE`` (good document) or 1 - ``SURE`` (bad). The field is fitted by gradient ascent in two steps:
first the likelihood of that evidence with lines independent, which tells how likely each training line is content, so that a line of a good
document that looks like those of bad ones becomes boilerplate; then the whole field, transitions included, to these
expected labels, which change within documents. It is fitted on at most ``max_train`` labelled documents and ``max_blocks`` runs of ``BLOCK`` neighbouring lines of
these, both chosen by hash over whole texts. All documents are then decoded in full, one pass, no shuffle.

Defined results: null text has no words and fails the base rules; without labels the field has no
weights and calls every line content; rows that repeat an id each get a result; empty tables give empty results;
only the named columns are read, so others cannot clash.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatledger.llm.common import as_bytes, batches, bounded_sample

FEATURES = ("bias", "length", "capitals", "digits", "symbols", "shouts", "pipes", "repeats_line", "repeats_words", "ends_sentence")
SYMBOLS = b"#*$%&|<>"
BLANK = b" \t\n\x0b\x0c\r"
#: Byte classes: 1 capital, 2 small letter or any byte beyond ASCII, 3 digit, 4 symbol, 5 exclamation mark.
KIND = np.zeros(256, np.uint8)
KIND[65:91] = 1
KIND[97:123] = KIND[128:] = 2
KIND[48:58] = 3
KIND[list(SYMBOLS)] = 4
KIND[33] = 5
#: Chance that a line of a good document is content, and one of a bad document boilerplate.
SURE = 0.85
#: Lines of a training run.
BLOCK = 64
OUT = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
     ("n_lines", pa.int64()), ("n_content_lines", pa.int64()), ("content_share", pa.float64()), ("base_failed", pa.bool_()), ("kept", pa.bool_())]
)


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words that lie in windows of ``width`` words found twice or more."""
    windows = list(zip(*[words[i:] for i in range(width)], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    hit = np.zeros(len(words) + 1, np.int64)
    at = np.array([i for i, w in enumerate(windows) if counts[w] > 1])
    np.add.at(hit, at, 1)
    np.add.at(hit, at + width, -1)
    return int((np.cumsum(hit[:-1]) > 0).sum())


def describe(text: bytes) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Counts (words, word characters, symbols, repeated lines, repeated words), features and word characters of each line with a word."""
    raw = text.split(b"\n")
    split = [line.split() for line in raw]
    lines = [(line, words) for line, words in zip(raw, split, strict=True) if words]
    words = [w for _, ws in lines for w in ws]
    seen: set[bytes] = set()
    x = np.zeros((len(lines), len(FEATURES)))
    if not lines:
        return [0, 0, sum(text.count(bytes([s])) for s in SYMBOLS), 0, 0], x, np.zeros(0)
    joined = np.frombuffer(b"".join(words), np.uint8)
    size = np.array([sum(map(len, ws)) for _, ws in lines])
    starts = np.concatenate(([0], np.cumsum(size)[:-1]))
    kind = KIND[joined]
    per = {k: np.add.reduceat((kind == k).astype(np.int64), starts) for k in range(1, 6)}
    chars = size - np.add.reduceat(((joined & 0xC0) == 0x80).astype(np.int64), starts)
    pipes = np.add.reduceat((joined == 124).astype(np.int64), starts)
    count = np.array([len(ws) for _, ws in lines])
    n_dup = 0
    for i, (line, ws) in enumerate(lines):
        if line in seen:
            n_dup += 1
            x[i, 7] = 1
        seen.add(line)
        x[i, 8] = 1 - len(set(ws)) / len(ws)
        x[i, 9] = ws[-1][-1] in b".?!"
    x[:, 0] = 1
    x[:, 1] = np.minimum(count, 40) / 40
    x[:, 2] = per[1] / np.maximum(1, per[1] + per[2])
    x[:, 3] = per[3] / size
    x[:, 4] = per[4] / size
    x[:, 5] = np.minimum(1, per[5] / count)
    x[:, 6] = pipes / count
    return [len(words), int(chars.sum()), int(per[4].sum()), n_dup, repeated_words(words)], x, chars


def viterbi(emit: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Likeliest labels (0 boilerplate, 1 content) of a line sequence; ties go to content."""
    if not len(emit):
        return np.zeros(0, np.int64)
    (m00, m01), (m10, m11) = move.tolist()
    rows = emit.tolist()
    a, b = rows[0]
    back = []
    for e0, e1 in rows[1:]:
        s0, t0 = (0, a + m00) if a + m00 > b + m10 else (1, b + m10)
        s1, t1 = (0, a + m01) if a + m01 > b + m11 else (1, b + m11)
        back.append((s0, s1))
        a, b = t0 + e0, t1 + e1
    label = 0 if a > b else 1
    path = [label]
    for step in reversed(back):
        label = step[label]
        path.append(label)
    return np.array(path[::-1])


def chain(emit: np.ndarray, on: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log of the sum over all label sequences, marginals of each line, expected transitions of all; ``on`` marks the lines there are."""
    longest = emit.shape[1]
    alpha, beta = np.zeros_like(emit), np.zeros_like(emit)
    alpha[:, 0] = emit[:, 0]
    for t in range(1, longest):
        new = np.logaddexp.reduce(alpha[:, t - 1, :, None] + move, axis=1) + emit[:, t]
        alpha[:, t] = np.where(on[:, t, None] > 0, new, alpha[:, t - 1])
    for t in range(longest - 2, -1, -1):
        new = np.logaddexp.reduce(move + (emit[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
        beta[:, t] = np.where(on[:, t + 1, None] > 0, new, 0.0)
    z = np.logaddexp.reduce(alpha[:, -1], axis=1)
    p = np.exp(alpha + beta - z[:, None, None]) * on[:, :, None]
    if longest < 2:
        return z, p, np.zeros((2, 2))
    q = np.exp(alpha[:, :-1, :, None] + move + (emit + beta)[:, 1:, None, :] - z[:, None, None, None]) * on[:, 1:, None, None]
    return z, p, q.sum(axis=(0, 1))


def likelihood(weight: np.ndarray, move: np.ndarray, x: np.ndarray, on: np.ndarray, evidence: np.ndarray, ridge: float = 1e-3) -> tuple[float, np.ndarray, np.ndarray]:
    """Log-likelihood a line of the documents' labels, and its gradients; ``evidence`` is the log of what a label says of each line label."""
    emit, total = np.einsum("nlf,kf->nlk", x, weight), on.sum()
    z, p, q = chain(emit, on, move)
    z_told, p_told, q_told = chain(emit + evidence[:, None, :] * on[:, :, None], on, move)
    value = (z_told - z).sum() / total - ridge / 2 * ((weight**2).sum() + (move**2).sum())
    return value, np.einsum("nlk,nlf->kf", p_told - p, x) / total - ridge * weight, (q_told - q) / total - ridge * move


def agreement(weight: np.ndarray, move: np.ndarray, x: np.ndarray, on: np.ndarray, expected: np.ndarray, ridge: float = 1e-3) -> tuple[float, np.ndarray, np.ndarray]:
    """Log-likelihood a line of expected line labels [n, line, 2], and its gradients."""
    emit, total = np.einsum("nlf,kf->nlk", x, weight), on.sum()
    z, p, q = chain(emit, on, move)
    pairs = np.einsum("nla,nlb->ab", expected[:, :-1], expected[:, 1:])
    value = ((expected * emit).sum() + (pairs * move).sum() - z.sum()) / total - ridge / 2 * ((weight**2).sum() + (move**2).sum())
    return value, np.einsum("nlk,nlf->kf", expected - p, x) / total - ridge * weight, (pairs - q) / total - ridge * move


def ascend(gradients, params: list[np.ndarray], rounds: int, rate: float) -> None:
    """Adam's steps up the gradients of the parameters, in place."""
    mean, square = ([np.zeros_like(w) for w in params] for _ in range(2))
    for r in range(1, rounds + 1):
        for k, (w, grad) in enumerate(zip(params, gradients(), strict=True)):
            mean[k] = 0.9 * mean[k] + 0.1 * grad
            square[k] = 0.999 * square[k] + 0.001 * grad**2
            w += rate * (mean[k] / (1 - 0.9**r)) / (np.sqrt(square[k] / (1 - 0.999**r)) + 1e-8)


def fit_field(docs: list[np.ndarray], labels: list[int], rounds: int = 100, rate: float = 0.2, sure: float = SURE) -> tuple[np.ndarray, np.ndarray]:
    """Weights [2, feature] and transitions [2, 2] fitted to lines of which only their documents' labels are known."""
    weight, move = np.zeros((2, len(FEATURES))), np.zeros((2, 2))
    pairs = [(x, y) for x, y in zip(docs, labels, strict=True) if len(x)]
    if not pairs:
        return weight, move
    n, longest = len(pairs), max(len(x) for x, _ in pairs)
    x = np.zeros((n, longest, len(FEATURES)))
    on = np.zeros((n, longest))
    for i, (f, _) in enumerate(pairs):
        x[i, : len(f)], on[i, : len(f)] = f, 1
    evidence = np.log(np.where(np.eye(2)[[y for _, y in pairs]] > 0, sure, 1 - sure))
    # independent lines: each one is a sequence of its own
    where = np.nonzero(on)
    lines, alone, told = x[where][:, None, :], np.ones((len(where[0]), 1)), evidence[where[0]]
    ascend(lambda: likelihood(weight, move, lines, alone, told)[1:2], [weight], rounds, rate)
    _, p, _ = chain(np.einsum("nlf,kf->nlk", lines, weight) + told[:, None, :], alone, move)
    expected = np.zeros((n, longest, 2))
    expected[where] = p[:, 0]
    ascend(lambda: agreement(weight, move, x, on, expected)[1:], [weight, move], rounds, rate)
    return weight, move


def _train_features():
    schema = pa.schema([("d", pa.int64()), ("k", pa.int32()), ("y", pa.int32()), ("x", pa.list_(pa.float64()))])

    def run(items):
        for b in batches(items):
            for d, text, y in zip(b.column(0).to_pylist(), as_bytes(b.column(1)), b.column(2).to_pylist(), strict=True):
                x = describe(text)[1]
                rows = [(d, k, y, x[at : at + BLOCK].ravel()) for k, at in enumerate(range(0, len(x), BLOCK))]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    return run


def train(docs: DataFrame, labels: DataFrame, max_train: int = 2000, max_blocks: int = 4000) -> tuple[np.ndarray, np.ndarray]:
    """The field fitted on at most ``max_train`` labelled documents; repeated labels count as good if one is."""
    said = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").alias("_q_id")).agg(F.max(F.col("quality").cast("int")).alias("y"))
    picked = said.join(F.broadcast(bounded_sample(said, "_q_id", max_train)), F.col("_q_id") == F.col("_s_id")).select("_q_id", "y")
    rows = docs.select(F.col("doc_id").alias("_d_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(picked), F.col("_d_id") == F.col("_q_id"))
    blocks = rows.select(F.col("_q_id").cast("long").alias("d"), "text", "y").mapInArrow(_train_features(), "d long, k int, y int, x array<double>")
    got = blocks.orderBy(F.xxhash64("d", "k"), "d", "k", "x").limit(max_blocks).toPandas()
    return fit_field([np.array(x).reshape(-1, len(FEATURES)) for x in got["x"]], got["y"].tolist())


def verdict(text: bytes, weight: np.ndarray, move: np.ndarray, least_words: int = 50, most_repeat: int = 50, least_share: float = 0.5) -> tuple:
    """Counts, lines, content lines, content share, base_failed and kept of a text."""
    counts, x, chars = describe(text)
    labels = viterbi(x @ weight.T, move)
    share = float((labels * chars).sum() / max(1, chars.sum()))
    failed = counts[0] < least_words or 100 * counts[4] > most_repeat * counts[0]
    return (*counts, len(x), int(labels.sum()), share, failed, not failed and share >= least_share)


def _judge(model):
    def run(items):
        weight, move = model.value
        for b in batches(items):
            rows = [verdict(t, weight, move) for t in as_bytes(b.column(1))]
            cols = [b.column(0), *[pa.array([r[i] for r in rows], OUT.field(i + 1).type) for i in range(len(OUT) - 1)]]
            yield pa.RecordBatch.from_arrays(cols, schema=OUT)

    return run


def judge(docs: DataFrame, labels: DataFrame, max_train: int = 2000) -> DataFrame:
    """Counts and verdict of every document; the columns are those of ``OUT``."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, max_train))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kinds = ", ".join(f"{f.name} {str(f.type).replace('int64', 'long').replace('bool', 'boolean')}" for f in OUT)
    return rows.mapInArrow(_judge(model), kinds)


def op6_quality(spark, sf_dir: str) -> DataFrame:
    """Whole ``documents``: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, and the field's counts."""
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
