"""Language identification by a byte convolutional network, written and trained in numpy.

Bytes of a fixed-length window go through filters of several widths, each filter's largest
response over the window is kept, and a softmax layer reads the languages from these. A text's
prediction is the mean over all its windows, so every byte of it counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import map_batches

#: The label of texts without a letter, and of all texts if nothing could be learned.
UNDETERMINED = "und"
#: Rows looked at for the training sample, as a multiple of those that are taken.
LEEWAY = 3
#: Rows of a language that are looked at as if so many were taken, where fewer are.
LEAST_ROWS = 16


@dataclass(frozen=True)
class Settings:
    """Bounds of the training sample, and the network's shape."""

    #: Most documents for each language, and languages that can have so many; more share the same number of rows.
    languages: int = 64
    docs_per_language: int = 300
    #: Bytes in a window; windows taken from each training document, anywhere in its text.
    window: int = 256
    windows_per_doc: int = 6
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 16
    steps: int = 500
    batch: int = 64
    rate: float = 0.01
    seed: int = 10
    #: Windows that go through the network at once.
    inference_batch: int = 256


def windows_of(text: bytes, size: int) -> np.ndarray:
    """Whole text as rows of ``size`` bytes, the last one filled up with zeros."""
    rows = max(1, -(-len(text) // size))
    return np.frombuffer(text.ljust(rows * size, b"\0"), np.uint8).reshape(rows, size)


@dataclass
class ByteNet:
    """Filters are one table of responses for each byte and each of their positions."""

    languages: list[str]
    settings: Settings
    filters: list[np.ndarray] = field(default_factory=list)  # for each width: (width, 256, filters)
    bias: np.ndarray | None = None
    out: np.ndarray | None = None
    out_bias: np.ndarray | None = None

    def start(self, random: np.random.Generator) -> None:
        s = self.settings
        total = len(s.widths) * s.filters
        self.filters = [random.normal(0, 0.3 / w**0.5, (w, 256, s.filters)).astype(np.float32) for w in s.widths]
        self.bias = np.zeros(total, np.float32)
        self.out = random.normal(0, 0.1, (total, len(self.languages))).astype(np.float32)
        self.out_bias = np.zeros(len(self.languages), np.float32)

    def _responses(self, x: np.ndarray, k: int) -> np.ndarray:
        table = self.filters[k]
        n = x.shape[1] - len(table) + 1
        out = table[0].take(x[:, :n], axis=0)
        for j in range(1, len(table)):
            out += table[j].take(x[:, j : j + n], axis=0)
        return out

    def train(self, x: np.ndarray, y: np.ndarray) -> None:
        """Adam on cross entropy; only the winning position of a filter has a gradient."""
        s, random = self.settings, np.random.default_rng(self.settings.seed)
        self.start(random)
        params = [*self.filters, self.bias, self.out, self.out_bias]
        first = [np.zeros_like(p) for p in params]
        second = [np.zeros_like(p) for p in params]
        share = 1 / np.bincount(y, minlength=len(self.languages)).clip(1)
        chance = share[y] / share[y].sum()
        for step in range(1, s.steps + 1):
            rows = random.choice(len(x), s.batch, p=chance)
            bx, by = x[rows].copy(), y[rows]
            short = random.integers(20, s.window + 1, s.batch)  # texts may be short
            short[random.random(s.batch) < 0.5] = s.window
            bx[np.arange(s.window)[None, :] >= short[:, None]] = 0
            best, pooled = [], []
            for k in range(len(s.widths)):
                r = self._responses(bx, k)
                at = r.argmax(axis=1)
                best.append(at)
                pooled.append(np.take_along_axis(r, at[:, None, :], 1)[:, 0])
            before = np.concatenate(pooled, 1) + self.bias
            hidden = np.maximum(before, 0)
            logits = hidden @ self.out + self.out_bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(s.batch), by] -= 1
            p /= s.batch
            back = (p @ self.out.T) * (before > 0)
            grads = []
            for k, w in enumerate(s.widths):
                g = np.zeros_like(self.filters[k])
                part = back[:, k * s.filters : (k + 1) * s.filters]
                for j in range(w):
                    np.add.at(g[j], (np.take_along_axis(bx, best[k] + j, 1), np.arange(s.filters)[None, :]), part)
                grads.append(g)
            grads += [back.sum(0), hidden.T @ p, p.sum(0)]
            for q, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                q -= s.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def fused(self) -> list[list[tuple[int, np.ndarray, bool]]]:
        """For each width its positions in pairs: (offset, table, whether the table is by two bytes)."""
        out = []
        for table in self.filters:
            parts = []
            for j in range(0, len(table) - 1, 2):
                both = (table[j][:, None, :] + table[j + 1][None, :, :]).reshape(65536, -1)
                parts.append((j, np.ascontiguousarray(both), True))
            if len(table) % 2:
                parts.append((len(table) - 1, table[-1], False))
            out.append(parts)
        return out

    def probabilities(self, x: np.ndarray, fused: list) -> np.ndarray:
        """A row of language probabilities for each window."""
        size, out = x.shape[1], []
        for a in range(0, len(x), self.settings.inference_batch):
            rows = x[a : a + self.settings.inference_batch]
            pairs = (rows[:, :-1].astype(np.int32) << 8) | rows[:, 1:]
            pooled = []
            for width, parts in zip(self.settings.widths, fused, strict=True):
                n, total = size - width + 1, None
                for j, table, by_two in parts:
                    got = table.take((pairs if by_two else rows)[:, j : j + n], axis=0)
                    total = got if total is None else np.add(total, got, out=total)
                pooled.append(total.max(axis=1))
            logits = np.maximum(np.concatenate(pooled, 1) + self.bias, 0) @ self.out + self.out_bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            out.append(p / p.sum(1, keepdims=True))
        return np.concatenate(out)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def chosen_windows(text: str, row_hash: int, settings: Settings) -> bytes:
    """``windows_per_doc`` windows of a whole text (all, if it has fewer), drawn by the hash of its row."""
    rows = windows_of(text.encode().lower(), settings.window)
    if len(rows) > settings.windows_per_doc:
        random = np.random.default_rng([settings.seed, row_hash & 2**64 - 1])
        rows = rows[np.sort(random.choice(len(rows), settings.windows_per_doc, replace=False))]
    return rows.tobytes()


def training_sample(docs: DataFrame, settings: Settings) -> list[tuple[str, bytes]]:
    """(lang, windows) of labelled rows that are not held out, of every language at least one.

    ``languages`` x ``docs_per_language`` rows are divided among the languages, with at most
    ``docs_per_language`` for each. Rows rank by a hash of doc_id and text; rows equal in both count
    once. Windows are chosen from whole texts in the executors; only they are sent to the driver.
    """
    named = docs.select("doc_id", "lang", "text").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    rows = named.select("lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"), F.min("h").alias("least")).collect()
    if not counts:
        return []
    each = min(settings.docs_per_language, max(1, settings.languages * settings.docs_per_language // len(counts)))
    # the smallest hashes of a language lie below a limit that lets about LEEWAY times as many rows through, and its first row always
    limits = [(r["lang"], max(r["least"], min(int(LEEWAY * max(each, LEAST_ROWS) / r["n"] * 2**64) - 2**63, 2**63 - 1))) for r in counts]
    limit = F.broadcast(docs.sparkSession.createDataFrame(limits, "lang string, most long"))
    near = rows.join(limit, "lang").where(F.col("h") <= F.col("most")).select("lang", "h", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()  # of hashes below the limits, which are few
        for batch in batches:
            langs, hashes, windows = [], [], []
            for lang, h, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (lang, h) not in seen:
                    seen.add((lang, h))
                    langs.append(lang)
                    hashes.append(h)
                    windows.append(chosen_windows(text, h, settings))
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(hashes, pa.int64()), pa.array(windows, pa.binary())], names=["lang", "h", "windows"])

    found = map_batches(near, run, "lang string, h long, windows binary").dropDuplicates(["lang", "h"])
    order = Window.partitionBy("lang").orderBy("h")
    sample = found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= each).collect()
    return [(r["lang"], bytes(r["windows"])) for r in sorted(sample, key=lambda r: (r["lang"], r["h"]))]


def fit(docs: DataFrame, settings: Settings = Settings()) -> ByteNet | None:
    """The trained network, or None where no labelled row can be learned from."""
    sample = training_sample(docs, settings)
    languages = sorted({lang for lang, _ in sample})
    if not languages:
        return None
    x, y = [], []
    for lang, windows in sample:
        rows = np.frombuffer(windows, np.uint8).reshape(-1, settings.window)
        x.append(rows)
        y += [languages.index(lang)] * len(rows)
    net = ByteNet(languages, settings)
    net.train(np.concatenate(x), np.array(y))
    return net


def predict(docs: DataFrame, net: ByteNet | None) -> DataFrame:
    """``docs`` columns with held_out, lang_pred and score added.

    All windows of a whole text are read. Null texts and texts without a letter are ``und`` with
    score 0, and so is every text if ``net`` is None. Repeated rows give repeated results. Columns
    of ``docs`` that are named like results are replaced.
    """
    names = [c for c in docs.columns if c not in ("held_out", "lang_pred", "score")]
    marked = docs.select(*names, held_out(F.col("doc_id")).alias("held_out"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fused = net.fused() if net else None
        for batch in batches:
            found, scores = [], []
            texts = batch.column("text").to_pylist()
            size = net.settings.window if net else 1
            for a in range(0, len(texts), 64):
                part = [t.encode().lower() if net and t and any(map(str.isalpha, t)) else None for t in texts[a : a + 64]]
                windows = [windows_of(t, size) for t in part if t is not None]
                at, p = 0, net.probabilities(np.concatenate(windows), fused) if windows else None
                for t in part:
                    if t is None:
                        found.append(UNDETERMINED)
                        scores.append(0.0)
                        continue
                    n = -(-len(t) // size)
                    weight = np.full(n, size, np.float64)
                    weight[-1] = len(t) - size * (n - 1)
                    mean = weight @ p[at : at + n] / len(t)
                    at += n
                    best = int(mean.argmax())
                    found.append(net.languages[best])
                    scores.append(float(min(1.0, mean[best])))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names, "lang_pred", "score"])

    out = T.StructType([*marked.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return map_batches(marked, run, out)
