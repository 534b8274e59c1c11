"""Operator 3: a quality classifier by co-training of two views.

The content view sees a text's words: words, frequent word beginnings and marks that
separate the labels, and a few shape measures.  The metadata view sees what is known
about the page without reading it: source, language, length.  Both are logistic
regressions.  They start from the labelled rows; in each round a view labels those of the
unlabelled rows that it is surest of, in the proportion of the classes, and the other
view trains on them too.  Then each view is calibrated on held-out labelled rows (Platt
scaling) and the calibrated views are combined by a logistic regression, also fitted on
held-out rows, whose threshold balances the errors.  All documents are scored.

A document is good if its label is quality 1 and toxic 0; everything else is rejected.

Every row without a label is in the pool.  The features of all rows are written once; a
round reads them, finds its cuts from histograms of the margins, and fits by Newton steps
whose loss, gradient and curvature are summed over the chosen rows in the tasks.  Which
rows earlier rounds chose follows from their weights and cuts, so no list of rows is kept.
The chosen rows together weigh ``PSEUDO`` of the labelled training rows, at any size.

Bounds: the fit sees at most ``FIT`` labelled rows, the ones with the smallest seeded hash
of their id that have a document.  Their texts are read whole: the words are counted in
Spark, and only those chosen as features reach the driver.  What the driver receives of
the pool has the size of the views (some 240,000 numbers a step).

Defined cases: a null or empty text has no words and length 0; a null source or language
is a value of its own; labels that are null or belong to no document are left out;
repeated rows are scored each; without rows of both classes, or with fewer than ``FEWEST``
labelled rows (too few to train, calibrate and hold some out), every score is the share of
good rows among the labelled ones (0.5 with no labels at all), and rows are kept from 0.5 on.
Among rows of one margin at a cut, a seeded hash of the id says which are chosen.
Texts of any length are counted and scored whole; equal texts with equal metadata have
equal scores; an empty table gives an empty result; all other columns, whatever their
names, are carried in ``carried``.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketflow.llm import kernels as K
from docketflow.llm.components import saved

FIT, ROUNDS, SHARE, FEATURES, META, FEWEST = 10_000, 3, 0.05, 400, 256, 20
#: Weight of all pseudo-labelled rows against the labelled ones; Newton steps of a round; how sure a view must be.
PSEUDO, STEPS, SURE = 0.2, 6, 0.95
#: Histogram of margins from -REACH to REACH; sums are exact multiples of 1 / GRID, whatever their order.
BINS, REACH, GRID = 4_000, 20.0, 1 << 20
BLOCK, CELL = 4_096, 4_096
SHAPES, L2, KEEP_FROM = 10, (2e-4, 1e-3), 0.5
FEATURE_COLUMNS = "cols binary, form binary, meta binary"
#: Lengths of word beginnings.
STARTS = (4, 5, 6)
TOKEN = re.compile(r"[^\W_]+|[^\w\s]{2,}|\|")


def word_set(text: str | None) -> set[str]:
    """Words and runs of marks of a text, and beginnings of words that are frequent in it, with how frequent they are."""
    counts = Counter(TOKEN.findall(text.lower())) if text else Counter()
    found, starts, total = set(counts), Counter(), sum(counts.values())
    for word, n in counts.items():
        if word.isalpha():
            for size in STARTS:
                if len(word) > size:
                    starts[word[:size]] += n
    for start, n in starts.items():
        if n > 1:
            found.add(f"{start}~{min(4, n.bit_length())}")
            if n * 200 >= total:
                found.add(f"{start}@{min(5, (n * 200 // total).bit_length())}")
    return found


def code(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass"))


def codes(text: str | None) -> list[int]:
    """The words of ``word_set`` as 32-bit codes: what the sample and the model hold."""
    return sorted({code(w) for w in word_set(text)})


def shape(text: str | None) -> list[float]:
    """Shares that describe a text's form."""
    text = text or ""
    words, n = text.split(), max(1, len(text))
    w = max(1, len(words))
    lines = text.count("\n") + 1
    return [
        np.log1p(len(words)) / 10, len(set(words)) / w, text.count("!") / w, sum(text.count(c) for c in "#$%&*@^~=<>{}[]\\") / w, text.count("|") / w,
        sum(map(text.count, ".,;:?")) / w, sum(map(str.isupper, words)) / w, sum(map(text.count, "0123456789")) / n, n / w / 10, np.log1p(lines) / 5,
    ]


def meta_row(source, lang, n_chars) -> list[int]:
    """Column numbers of the metadata view."""
    size = int(np.log2(max(1, n_chars or 0)) * 2)
    return sorted({zlib.crc32(t.encode()) % META for t in (f"s{source}", f"l{lang}", f"n{size}", f"l{lang}n{size}")})


def logistic(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, y: np.ndarray, weight: np.ndarray, width: int, l2: float, steps: int = 200) -> np.ndarray:
    """Weights (the last is the intercept) of a logistic regression on sparse rows, by accelerated gradient steps."""
    n, total = len(y), max(1e-9, weight.sum())
    v = np.ones(width + 1)
    for _ in range(20):  # largest curvature, by power iteration
        z = (np.bincount(rows, weights=values * v[cols], minlength=n) + v[-1]) * weight / total
        v = np.append(np.bincount(cols, weights=values * z[rows], minlength=width), z.sum())
        curve = np.linalg.norm(v)
        v /= max(1e-12, curve)
    rate = 1 / (0.3 * curve + l2)
    beta, look, t = np.zeros(width + 1), np.zeros(width + 1), 1.0
    for _ in range(steps):
        z = np.bincount(rows, weights=values * look[cols], minlength=n) + look[-1]
        miss = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight / total
        grad = np.append(np.bincount(cols, weights=values * miss[rows], minlength=width), miss.sum())
        grad[:-1] += l2 * look[:-1]
        after = look - rate * grad
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look = after + (t - 1) / t_next * (after - beta)
        beta, t = after, t_next
    return beta


def margins(rows, cols, values, beta, n) -> np.ndarray:
    return np.bincount(rows, weights=values * beta[cols], minlength=n) + beta[-1]


def platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale and shift that calibrate margins to probabilities."""
    hi, lo = (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2)
    target, x = np.where(y > 0, hi, lo), np.clip(margin, -20, 20)

    def loss(a, b):
        z = a * x + b
        return (np.logaddexp(0, z) - target * z).sum() + 0.05 * a * a

    a, b, step = 1.0, 0.0, np.ones(2)
    for _ in range(50):  # Newton steps, halved until they help
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([((p - target) * x).sum() + 0.1 * a, (p - target).sum()])
        w = p * (1 - p) + 1e-9
        step = np.linalg.solve(np.array([[(w * x**2).sum() + 0.1, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]]), g)
        while abs(step).max() > 1e-8 and loss(a - step[0], b - step[1]) > loss(a, b):
            step /= 2
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-8:
            break
    return float(a), float(b)


class Model:
    """The fitted views; small and of fixed size, so it goes to the tasks as a broadcast."""

    def __init__(self, prior: float):
        self.prior, self.columns = prior, {}

    def described(self, texts: list, sources: list, langs: list) -> pd.DataFrame:
        """Features of both views as they are kept: column numbers of words, standardised shape, column numbers of metadata."""
        cols = [np.array(sorted(self.columns[c] for c in codes(t) if c in self.columns), np.uint16).tobytes() for t in texts]
        form = self.standard(np.array([shape(t) for t in texts]).reshape(len(texts), SHAPES))
        meta = [np.array(meta_row(s, g, len(t) if t else 0), np.uint16).tobytes() for t, s, g in zip(texts, sources, langs, strict=True)]
        return pd.DataFrame({"cols": cols, "form": [f.tobytes() for f in form], "meta": meta})

    def standard(self, form: np.ndarray) -> np.ndarray:
        return np.clip((form - self.mean) / self.spread, -4, 4).astype(np.float32)

    @property
    def widths(self) -> tuple[int, int]:
        return len(self.columns) + SHAPES, META

    def scores(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated content and metadata probabilities, and the combined one, of described rows."""
        a, b = (margins(*v, beta, batch.num_rows) for v, beta in zip(views(batch, self.widths[0]), self.betas, strict=True))
        return self.combined(a, b)

    def combined(self, a, b):
        za, zb = self.cal_content[0] * a + self.cal_content[1], self.cal_meta[0] * b + self.cal_meta[1]
        z = np.clip(za, -30, 30) * self.blend[0] + np.clip(zb, -30, 30) * self.blend[1] + self.blend[2]
        return tuple(1 / (1 + np.exp(-np.clip(x, -30, 30))) for x in (za, zb, z))


def views(batch: pa.RecordBatch, width: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Both views of described rows as row numbers, columns and values; ``width`` columns in the content view."""
    n = batch.num_rows

    def numbers(name: str, kind) -> tuple[np.ndarray, np.ndarray]:
        raw, starts = K.text_buffers(batch.column(name))
        return np.repeat(np.arange(n), np.diff(starts) // np.dtype(kind).itemsize), np.frombuffer(raw[starts[0] : starts[-1]].tobytes(), kind)

    (words, cols), (forms, values), (metas, tags) = numbers("cols", np.uint16), numbers("form", np.float32), numbers("meta", np.uint16)
    content = np.concatenate([words, forms]), np.concatenate([cols.astype(np.int64), np.tile(np.arange(width - SHAPES, width), n)]), np.concatenate([np.ones(len(cols)), values])
    return [content, (metas, tags.astype(np.int64), np.ones(len(tags)))]


def bins(margin: np.ndarray) -> np.ndarray:
    return np.clip((margin + REACH) * (BINS / (2 * REACH)), 0, BINS - 1).astype(np.int64)


def cut(counts: np.ndarray, want: float) -> tuple[int, float]:
    """The last bin from which the ``want`` highest rows come, and the share of its rows that is taken; none below SURE."""
    least = int(bins(np.array([np.log(SURE / (1 - SURE))]))[0])
    above = np.cumsum(counts[::-1])[::-1]
    if want <= 0:
        return BINS - 1, 0.0
    if above[least] <= want:
        return least, 1.0
    k = int(np.flatnonzero(above >= want)[-1])
    return k, float((want - above[k] + counts[k]) / counts[k])


def chosen(both: list, luck: np.ndarray, history: list) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each view, which rows have a pseudo-label in it after the rounds of ``history``, and the label."""
    n = len(luck)
    out = [(np.zeros(n, bool), np.zeros(n)) for _ in both]
    for betas, cuts in history:
        for v in (0, 1):  # view v labels rows for the other one
            active, label = out[1 - v]
            at = bins(margins(*both[v], betas[v], n))
            picked = []
            for place, (last, share) in zip((at, BINS - 1 - at), cuts[v], strict=True):
                picked.append(~active & ((place > last) | ((place == last) & (luck < share))))
            active |= picked[0] | picked[1]
            label[picked[0]] = 1.0
    return out


def statistics(rows, cols, values, y: np.ndarray, active: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """Number, loss, gradient and curvature of a logistic regression over the active rows, as one vector."""
    number = np.cumsum(active) - 1
    keep = active[rows]
    x = np.zeros((int(active.sum()), len(beta)))
    x[number[rows[keep]], cols[keep]] = values[keep]
    x[:, -1] = 1
    z, y = np.clip(x @ beta, -30, 30), y[active]
    p = 1 / (1 + np.exp(-z))
    return np.concatenate([[len(x), (np.logaddexp(0, z) - y * z).sum()], x.T @ (p - y), ((x.T * (p * (1 - p))) @ x).ravel()])


def summed(table: DataFrame, work, length: int) -> np.ndarray:
    """Sum of the vectors that ``work`` makes of blocks of rows: added up in each task, then cell by cell of the vector."""

    def add(batches):
        total = np.zeros(length)
        for batch in batches:
            for k in range(0, batch.num_rows, BLOCK):
                total += work(batch.slice(k, BLOCK))
        whole = np.rint(total * GRID).astype(np.int64)
        cells = [whole[k : k + CELL].tobytes() for k in range(0, length, CELL)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(cells)), pa.int32()), pa.array(cells, pa.binary())], ["cell", "sums"])

    def merge(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for cell, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found[cell] = found.get(cell, 0) + np.frombuffer(sums, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([v.tobytes() for v in found.values()], pa.binary())], ["cell", "sums"])

    shape = "cell int, sums binary"
    parts = table.mapInArrow(add, shape).repartition(8, "cell").mapInArrow(merge, shape).collect()
    out = np.zeros(length)
    for r in parts:  # one for each cell
        out[r.cell * CELL : r.cell * CELL + CELL] = np.frombuffer(r.sums, np.int64) / GRID
    return out


def held_out(known: np.ndarray) -> np.ndarray:
    return known & (np.arange(len(known)) % 4 == 3)


class CoTraining:
    """The labelled sample, both views' weights, and the rounds so far."""

    def __init__(self, rows: pd.DataFrame):
        """``rows``: words, form, source, lang, size, y, ordered by the seeded hash."""
        y = rows["y"].to_numpy(np.float64)
        self.model = model = Model(float(y.mean()) if len(y) else 0.5)
        self.y, self.held, self.history = y, held_out(np.ones(len(y), bool)), []
        self.train = ~self.held
        if len(y) < FEWEST or len(set(y)) < 2:
            return
        words = [np.asarray(w, np.int64) for w in rows["words"]]
        n_bad, n_good = int((1 - y[self.train]).sum()), int(y[self.train].sum())
        seen = [np.unique(np.concatenate([np.zeros(0, np.int64), *(words[k] for k in np.flatnonzero(self.train & (y == side)))]), return_counts=True) for side in (0, 1)]
        every = np.union1d(seen[0][0], seen[1][0])
        bad, good = np.zeros(len(every)), np.zeros(len(every))
        for counts, (u, n) in zip((bad, good), seen, strict=True):
            counts[np.searchsorted(every, u)] = n
        both = bad + good
        expected = both * n_bad / (n_bad + n_good)
        chi = np.where(both >= 4, (bad - expected) ** 2 / expected + (bad - expected) ** 2 / np.maximum(1e-9, both - expected), -1)
        best = every[np.lexsort((every, -chi))[:FEATURES]][: int((chi >= 0).sum())]
        model.columns = {int(w): k for k, w in enumerate(best)} or {-1: 0}
        form = np.array(rows["form"].tolist())
        model.mean, model.spread = form[self.train].mean(0), form[self.train].std(0) + 1e-6
        cols = [np.array(sorted(model.columns[w] for w in ws.tolist() if w in model.columns), np.uint16).tobytes() for ws in words]
        meta = [np.array(meta_row(*x), np.uint16).tobytes() for x in zip(rows["source"], rows["lang"], rows["size"], strict=True)]
        self.own = views(pa.RecordBatch.from_pydict({"cols": cols, "form": [f.tobytes() for f in model.standard(form)], "meta": meta}), model.widths[0])
        model.betas = [logistic(*v, y, self.train.astype(float), w, l2) for v, w, l2 in zip(self.own, model.widths, L2, strict=True)]

    def round(self, pool: DataFrame) -> None:
        """Each view labels the rows of the pool that it is surest of; both are fitted anew."""
        model, history, width = self.model, self.history, self.model.widths[0]
        betas = list(model.betas)

        def free(batch):
            both, luck = views(batch, width), batch.column("luck").to_numpy()
            picked = chosen(both, luck, history)
            counts = [np.bincount(bins(margins(*both[v], betas[v], len(luck)))[~picked[1 - v][0]], minlength=BINS) for v in (0, 1)]
            return np.concatenate([[len(luck)], *counts])

        found = summed(pool, free, 1 + 2 * BINS)
        want = SHARE * found[0]
        n_bad = min(want, max(1.0, want * (1 - model.prior)))
        counts = found[1 : 1 + BINS], found[1 + BINS :]
        self.history = [*history, (betas, [(cut(h, want - n_bad), cut(h[::-1], n_bad)) for h in counts])]
        self.newton(pool)

    def newton(self, pool: DataFrame) -> None:
        """Newton steps from the present weights, halved where they don't help."""
        model, history, width = self.model, self.history, self.model.widths[0]
        sizes = [2 + (w + 1) + (w + 1) ** 2 for w in model.widths]
        best, tried, rate = [None, None], list(model.betas), [1.0, 1.0]
        for _ in range(STEPS):

            def local(batch, tried=tuple(tried)):
                both = views(batch, width)
                picked = chosen(both, batch.column("luck").to_numpy(), history)
                return np.concatenate([statistics(*v, label, active, beta) for v, (active, label), beta in zip(both, picked, tried, strict=True)])

            pooled = np.split(summed(pool, local, sum(sizes)), [sizes[0]])
            for v in (0, 1):
                loss, slope, curve = self.objective(v, tried[v], pooled[v])
                if best[v] is None or loss <= best[v][0]:
                    best[v], rate[v] = (loss, tried[v], np.linalg.solve(curve, slope)), 1.0
                else:
                    rate[v] /= 4
                tried[v] = best[v][1] - rate[v] * best[v][2]
            if all(np.abs(r * b[2]).max() < 1e-3 for r, b in zip(rate, best, strict=True)):
                break
        model.betas = [b[1] for b in best]

    def objective(self, v: int, beta: np.ndarray, pooled: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Mean loss with its penalty, gradient and curvature, over the labelled rows and the pool's part."""
        own = statistics(*self.own[v], self.y, self.train, beta)
        weight = PSEUDO * own[0] / max(1.0, pooled[0])
        total = own + weight * pooled
        w, ridge = len(beta), np.append(np.full(len(beta) - 1, L2[v]), 1e-9)
        n, loss, slope, curve = total[0], total[1], total[2 : 2 + w], total[2 + w :].reshape(w, w)
        return float(loss / n + (ridge * beta**2).sum() / 2), slope / n + ridge * beta, curve / n + np.diag(ridge)

    def finish(self) -> Model:
        """Calibration and combination of the views on the held-out labelled rows."""
        model, held = self.model, self.held
        y = self.y[held]
        a, b = (margins(*v, beta, len(self.y))[held] for v, beta in zip(self.own, model.betas, strict=True))
        model.cal_content, model.cal_meta = platt(a, y), platt(b, y)
        both = np.stack([np.clip(s * x + t, -30, 30) for x, (s, t) in ((a, model.cal_content), (b, model.cal_meta))], 1)
        model.blend = logistic(np.repeat(np.arange(len(y)), 2), np.tile([0, 1], len(y)), both.ravel(), y, np.ones(len(y)), 2, 1e-4, 400)
        return model


def truth(labels: DataFrame) -> DataFrame:
    """doc_id and y, 1 for good and 0 for bad, of every labelled id."""
    known = labels.where("doc_id is not null and quality is not null and toxic is not null")
    return known.groupBy("doc_id").agg(F.min(F.when((F.col("quality") == 1) & (F.col("toxic") == 0), 1.0).otherwise(0.0)).alias("y"))


def sample(docs: DataFrame, labels: DataFrame, seed: int = 3) -> pd.DataFrame:
    """The bounded sample of labelled rows that the fit sees."""
    pick = F.xxhash64(F.lit(seed), "doc_id")
    ids = docs.select("doc_id").where("doc_id is not null").distinct()
    wanted = truth(labels).join(ids, "doc_id", "left_semi").orderBy(pick, "doc_id").limit(FIT)  # FIT ids at most

    def describe(batches):
        for rows in batches:
            words = [np.array(codes(t), np.uint32).tobytes() for t in rows["text"]]
            yield pd.DataFrame({"doc_id": rows["doc_id"], "words": words, "form": [shape(t) for t in rows["text"]], "source": rows["source"], "lang": rows["lang"], "size": rows["size"], "y": rows["y"]})

    src = docs.select("doc_id", "text", F.col("source").cast("string"), F.col("lang").cast("string"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("size"))
    described = src.join(F.broadcast(wanted), "doc_id").mapInPandas(describe, "doc_id long, words binary, form array<double>, source string, lang string, size long, y double")
    table = saved(described.dropDuplicates(["doc_id"]), "sample")
    found = table.drop("words").toArrow().to_pandas()
    found["rank"] = [zlib.crc32(str(int(i)).encode()) for i in found["doc_id"]]
    found = found.sort_values(["rank", "doc_id"]).reset_index(drop=True)
    best = separating(table, found[~held_out(np.ones(len(found), bool))])

    def narrow(batches):
        for rows in batches:
            words = [np.frombuffer(w, np.uint32) for w in rows["words"]]
            yield pd.DataFrame({"doc_id": rows["doc_id"], "words": [w[np.isin(w, best)].tobytes() for w in words]})

    words = table.select("doc_id", "words").mapInPandas(narrow, "doc_id long, words binary").toArrow().to_pandas()
    by_id = dict(zip(words["doc_id"], words["words"], strict=True))
    found["words"] = [np.frombuffer(by_id[i], np.uint32) for i in found["doc_id"]]
    return found


def separating(table: DataFrame, train: pd.DataFrame) -> np.ndarray:
    """The codes that ``fit`` chooses by chi-square, counted over all words of the training rows."""
    good, bad = (set(train["doc_id"][train["y"] == side].tolist()) for side in (1, 0))
    if not good or not bad:
        return np.zeros(0, np.uint32)

    def count(batches):
        for rows in batches:
            sides = {}
            for name, ids in (("good", good), ("bad", bad)):
                mine = [np.frombuffer(w, np.uint32) for i, w in zip(rows["doc_id"], rows["words"], strict=True) if i in ids]
                u, n = np.unique(np.concatenate([np.zeros(0, np.uint32), *mine]), return_counts=True)
                sides[name] = pd.Series(n, u.astype(np.int64))
            out = pd.DataFrame(sides).fillna(0).astype(np.int64)
            yield out.rename_axis("code").reset_index()[["code", "good", "bad"]]

    both = F.col("good") + F.col("bad")
    counts = table.select("doc_id", "words").mapInPandas(count, "code long, good long, bad long").groupBy("code").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).where(both >= 4)
    expected = both * len(bad) / (len(good) + len(bad))
    off = (F.col("bad") - expected) * (F.col("bad") - expected)
    top = counts.select("code", (off / expected + off / F.greatest(F.lit(1e-9), both - expected)).alias("chi")).orderBy(F.desc("chi"), "code").limit(FEATURES)
    return np.array([r.code for r in top.collect()], np.uint32)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row of ``docs`` with doc_id, text, carried (its other columns), p_content, p_meta, score, keep."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    source, lang = F.col("source").cast("string"), F.col("lang").cast("string")
    work = CoTraining(sample(docs, labels))
    if not work.model.columns:
        p = F.lit(work.model.prior)
        return docs.select("doc_id", "text", F.struct(*rest).alias("carried"), p.alias("p_content"), p.alias("p_meta"), p.alias("score"), (p >= KEEP_FROM).alias("keep"))
    start = docs.sparkSession.sparkContext.broadcast({k: getattr(work.model, k) for k in ("columns", "mean", "spread")})

    @F.pandas_udf(FEATURE_COLUMNS)
    def described(text: pd.Series, source: pd.Series, lang: pd.Series) -> pd.DataFrame:
        model, out = Model(0.5), []
        vars(model).update(start.value)
        for k in range(0, len(text), 500):
            out.append(model.described(*(x.iloc[k : k + 500].tolist() for x in (text, source, lang))))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame({"cols": [], "form": [], "meta": []})

    luck = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    table = saved(docs.select("doc_id", "text", F.struct(*rest).alias("carried"), luck.alias("luck"), described(F.col("text"), source, lang).alias("f")), "features")
    rows = table.select("doc_id", "luck", "f.*")
    known = truth(labels).select("doc_id")
    pool = rows.where("doc_id is not null").join(known, "doc_id", "left_anti").unionByName(rows.where("doc_id is null"))
    pool = saved(pool.drop("doc_id"), "pool")
    for _ in range(ROUNDS):
        work.round(pool)
    fitted = docs.sparkSession.sparkContext.broadcast(vars(work.finish()))

    @F.pandas_udf("p_content double, p_meta double, score double")
    def scored(cols: pd.Series, form: pd.Series, meta: pd.Series) -> pd.DataFrame:
        model = Model(0.5)
        vars(model).update(fitted.value)
        batch = pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in (cols, form, meta)], ["cols", "form", "meta"])
        return pd.DataFrame(np.stack(model.scores(batch), 1), columns=["p_content", "p_meta", "score"])

    found = table.select("doc_id", "text", "carried", scored("f.cols", "f.form", "f.meta").alias("s"))
    return found.select("doc_id", "text", "carried", "s.*", (F.col("s.score") >= KEEP_FROM).alias("keep"))


def op3_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Query over the whole of ``documents`` and ``labels``: doc_id, p_content, p_meta, score, keep."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return classify(docs, labels).select("doc_id", "p_content", "p_meta", "score", "keep")
