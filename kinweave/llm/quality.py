"""Quality rules: base rules and gradient-boosted trees over document statistics.

Statistics come from every whole text in one Python pass (byte histograms and, for words in repeated windows, exact ranks of
1, 2, 4 and 8 words built by doubling). The trees are trained here, on the driver, on a sample of labelled documents of at
most `most_labels` rows (those with the smallest hashes of their ids); everything else covers all rows. Trees grow by
second-order gain over binned statistics; along the statistics in FALLING the score may only fall: a split that would raise
it is not taken, and children's values stay on their side of the split's middle. The trees are flattened into numpy arrays
(statistic, threshold, left, right, value), broadcast (a few kB whatever the input), and scored a batch at a time.

Words are runs of anything but ASCII white space. A document fails the base rules with under 20 words or over 30 % of its
words in repeated windows. Without labels of both kinds there is no model and the base rules decide.

Nulls: a null text is empty and fails; null ids keep their rows; labels with null id or quality are ignored, and of several
labels of an id the lowest counts. Repeated rows are rows of their own. An empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm import workers
from kinweave.llm.tokens import slices

WINDOW = 8
MOST_LABELS = 20_000
#: The share of good documents that may go, and the share of junk that must, both on labels held out.
SPARE, CAUGHT = 0.001, 0.95
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_digits", "n_marks", "n_lines", "n_distinct")
STATISTICS = ("words", "word_length", "symbols", "dup_lines", "repeats", "upper", "digits", "marks", "line_words", "distinct")
FALLING = ("symbols", "dup_lines", "repeats", "upper", "marks")


def repeated(cut: list[list[bytes]], window: int = WINDOW) -> list[int]:
    """For each text's words, how many lie in a window of words that the text holds at least twice."""
    sizes = np.array([len(ws) for ws in cut], np.int64)
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    if not total:
        return [0] * len(cut)
    names = {w: i for i, w in enumerate(set().union(*map(set, cut)))}
    rank = np.fromiter((names[w] for ws in cut for w in ws), np.int64, total)
    span = 1
    while span * 2 <= window:  # ranks of twice as many words; the last ones of a text run on, their windows are not used
        if len(rank) <= span:
            return [0] * len(cut)
        pair = rank[:-span] * (int(rank.max()) + 1) + rank[span:]
        rank = np.unique(pair, return_inverse=True)[1].reshape(-1)
        span *= 2
    doc = np.repeat(np.arange(len(cut)), sizes)
    spot = np.flatnonzero(np.arange(total) + window <= ends[doc])
    if not len(spot):
        return [0] * len(cut)
    key = rank[spot] * len(cut) + doc[spot]
    _, back, n = np.unique(key, return_inverse=True, return_counts=True)
    twice = spot[n[back.reshape(-1)] > 1]
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + window, -1)
    held = np.cumsum(edge[:-1]) > 0
    return np.bincount(doc, held, len(cut)).astype(np.int64).tolist()


def counts_of(texts: list[str | None]) -> list[tuple[int, ...]]:
    workers.serve("quality")
    data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    cut = [d.split() for d in data]
    out = []
    for d, ws, again in zip(data, cut, repeated(cut)):
        seen = np.bincount(np.frombuffer(d, np.uint8), minlength=256)
        lines = [x for x in d.split(b"\n") if x.strip(SPACES)]
        points = len(d) - int(seen[0x80:0xC0].sum())
        marks = int(seen[33:48].sum() + seen[58:65].sum()) - int(seen[list(b",.")].sum())
        out.append((len(ws), points - int(seen[list(SPACES)].sum()), int(seen[list(SYMBOLS)].sum()), len(lines) - len(set(lines)), again, int(seen[65:91].sum()), int(seen[48:58].sum()), marks, len(lines), len(set(ws))))
    return out


def statistics(counts: np.ndarray) -> np.ndarray:
    """The model's inputs, in the order of STATISTICS, from columns in the order of COUNTS."""
    w, chars, symbols, dups, repeats, upper, digits, marks, lines, distinct = counts.astype(float).T
    words, points = np.maximum(w, 1), np.maximum(chars, 1)
    return np.stack([np.log1p(w), chars / words, symbols / words, dups / np.maximum(lines, 1), repeats / words, upper / points, digits / points, marks / words, w / np.maximum(lines, 1), distinct / words], 1)


class Trees:
    """Boosted regression trees for the log odds of label 1, flattened."""

    def __init__(self, base: float, roots: list[int], nodes: list[list[float]]):
        self.base, self.roots = base, np.array(roots, np.int64)
        at = np.array(nodes, float).reshape(-1, 5)
        self.column, self.limit = at[:, 0].astype(np.int64), at[:, 1]
        self.left, self.right, self.value = at[:, 2].astype(np.int64), at[:, 3].astype(np.int64), at[:, 4]
        self.cut = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        while (self.column[at] >= 0).any():
            inner = self.column[at]
            low = x[rows, np.maximum(inner, 0)] <= self.limit[at]
            at = np.where(inner < 0, at, np.where(low, self.left[at], self.right[at]))
        return self.base + self.value[at].sum(1)


def train(x: np.ndarray, y: np.ndarray, signs: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, least: float = 5.0, ridge: float = 1.0) -> Trees:
    """signs: -1 where the score may only fall along a column, 1 where it may only rise, 0 where it is free."""
    n, width = x.shape
    limits = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(width)]
    binned = np.stack([np.searchsorted(limits[j], x[:, j], side="left") for j in range(width)], 1)
    p0 = min(max(float(y.mean()), 1e-4), 1 - 1e-4)
    base = float(np.log(p0 / (1 - p0)))
    f, roots, nodes = np.full(n, base), [], []

    def grow(rows, g, h, low, high, level) -> int:
        own = len(nodes)
        total_g, total_h = g[rows].sum(), h[rows].sum()
        value = float(np.clip(total_g / (total_h + ridge), low, high))
        nodes.append([-1, 0.0, 0, 0, rate * value])
        best = (1e-6, -1, 0, 0.0, 0.0)
        if level < depth:
            for j in range(width):
                k = len(limits[j]) + 1
                gl = np.cumsum(np.bincount(binned[rows, j], g[rows], k))[:-1]
                hl = np.cumsum(np.bincount(binned[rows, j], h[rows], k))[:-1]
                gr, hr = total_g - gl, total_h - hl
                vl, vr = np.clip(gl / (hl + ridge), low, high), np.clip(gr / (hr + ridge), low, high)
                gain = (gl * vl - 0.5 * (hl + ridge) * vl**2) + (gr * vr - 0.5 * (hr + ridge) * vr**2) - (total_g * value - 0.5 * (total_h + ridge) * value**2)
                ok = (hl * 4 >= least) & (hr * 4 >= least) & (signs[j] * (vr - vl) >= 0)
                if ok.any() and (top := float(np.where(ok, gain, -np.inf).max())) > best[0]:
                    c = int(np.argmax(np.where(ok, gain, -np.inf)))
                    best = (top, j, c, float(vl[c]), float(vr[c]))
        if best[1] >= 0:
            _, j, c, vl, vr = best
            left, middle = binned[rows, j] <= c, (vl + vr) / 2
            bounds = ((low, high), (low, high)) if not signs[j] else ((low, middle), (middle, high)) if signs[j] > 0 else ((middle, high), (low, middle))
            a = grow(rows[left], g, h, *bounds[0], level + 1)
            b = grow(rows[~left], g, h, *bounds[1], level + 1)
            nodes[own] = [j, float(limits[j][c]), a, b, 0.0]
        return own

    for _ in range(trees):
        p = 1 / (1 + np.exp(-f))
        roots.append(grow(np.arange(n), y - p, p * (1 - p), -np.inf, np.inf, 0))
        f = Trees(base, roots[-1:], nodes).score(x) - base + f
    return Trees(base, roots, nodes)


def _counted(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            rows = [r for lo, hi in slices(texts) for r in counts_of(texts[lo:hi])]
            cols = zip(*rows) if rows else [[]] * len(COUNTS)
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, pa.int64()) for c in cols]], ["doc_id", *COUNTS])

    return docs.mapInArrow(workers.tidy(run), "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))


def cut_of(good: np.ndarray, junk: np.ndarray, spare: float, caught: float) -> float:
    """Log odds of 0, or lower, so that at most the share `spare` of the good scores is below; but never so low that less than the
    share `caught` of the junk scores is, where a cut of 0 would catch it."""
    low = np.sort(good)[int(spare * len(good))] if len(good) else 0.0
    least = np.sort(junk)[min(len(junk) - 1, int(caught * len(junk)))] if len(junk) else 0.0
    return float(max(min(0.0, low), min(0.0, least)))


def fit(docs: DataFrame, labels: DataFrame, most_labels: int = MOST_LABELS, spare: float = SPARE, caught: float = CAUGHT) -> Trees | None:
    """The trees, with the cut below which documents go, chosen on a quarter of the sample that the trees don't see (on all of it
    where that has under 20 of either kind). docs: doc_id, text."""
    sample = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_labels)
    sample = F.broadcast(sample.select(F.col("doc_id").alias("own"), "quality"))  # at most most_labels rows
    counted = _counted(docs.join(sample.select("own"), F.col("own") == F.col("doc_id")).select("doc_id", "text"))
    known = counted.where("n_words >= 20 and 100 * n_repeat_words <= 30 * n_words").join(sample, F.col("own") == F.col("doc_id"))
    held = (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)) == 0).alias("held")
    rows = known.groupBy("doc_id").agg(F.min(F.struct("quality", *COUNTS)).alias("r")).select("doc_id", "r.*", held).orderBy("doc_id").collect()
    y = np.array([float(r["quality"] > 0) for r in rows])
    if not len(y) or y.min() == y.max():
        return None
    x = statistics(np.array([[r[c] for c in COUNTS] for r in rows]))
    apart = np.array([r["held"] for r in rows])
    if min((apart & (y > 0)).sum(), (apart & (y == 0)).sum()) < 20:
        apart = np.ones(len(y), bool)
        seen = apart
    else:
        seen = ~apart
    model = train(x[seen], y[seen], np.array([-1 if s in FALLING else 0 for s in STATISTICS]))
    score = model.score(x[apart])
    model.cut = cut_of(score[y[apart] > 0], score[y[apart] == 0], spare, caught)
    return model


def verdicts(n: np.ndarray, model: Trees | None) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """base_failed, kept, score of rows of counts."""
    failed = (n[:, 0] < 20) | (100 * n[:, 4] > 30 * n[:, 0])
    if model is None:
        return failed, ~failed, None
    score = model.score(statistics(n))
    return failed, ~failed & (score >= model.cut), score


def judge(docs: DataFrame, labels: DataFrame | None, *, id_col: str = "doc_id", text_col: str = "text", most_labels: int = MOST_LABELS) -> DataFrame:
    """doc_id, the counts, score (log odds, null without a model), base_failed and kept of every row, in one pass over the texts."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    model = fit(own, labels, most_labels) if labels is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            n = np.array([r for lo, hi in slices(texts) for r in counts_of(texts[lo:hi])], np.int64).reshape(-1, len(COUNTS))
            failed, kept, score = verdicts(n, model)
            told = pa.array(score) if score is not None else pa.nulls(len(n), pa.float64())
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c) for c in n.T], told, pa.array(failed), pa.array(kept)], ["doc_id", *COUNTS, "score", "base_failed", "kept"])

    return own.mapInArrow(workers.tidy(run), "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", score double, base_failed boolean, kept boolean")


def keep_good(docs: DataFrame, labels: DataFrame | None, *, id_col: str = "doc_id", text_col: str = "text", most_labels: int = MOST_LABELS) -> DataFrame:
    """The rows that judge() keeps, all columns as they were."""
    model = fit(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), labels, most_labels) if labels is not None else None
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(at).to_pylist()
            n = np.array([r for lo, hi in slices(texts) for r in counts_of(texts[lo:hi])], np.int64).reshape(-1, len(COUNTS))
            yield b.filter(pa.array(verdicts(n, model)[1]))

    return docs.mapInArrow(workers.tidy(run), docs.schema)
