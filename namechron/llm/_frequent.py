"""The most frequent strings of a table's texts, from bounded reports that are merged as a tree."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import map_batches, materialize

#: Strings that a task counts at a time; beyond it the rare half goes.
COUNTED = 400_000
#: Reports that are merged by one task, and at most that many by the driver.
FAN = 8


def _report(counts: Counter, most: int) -> pa.RecordBatch:
    top = [(w, n) for w, n in counts.most_common(most) if n > 1]
    words, numbers = [w for w, _ in top], [n for _, n in top]
    return pa.RecordBatch.from_arrays([pa.array([words], pa.list_(pa.string())), pa.array([numbers], pa.list_(pa.int64()))], names=["words", "counts"])


def frequent(docs: DataFrame, units: Callable[[str], Iterable[str]], most: int, longest: int) -> list[str]:
    """At most ``most`` strings of the most frequent ones that ``units`` finds in all texts, most frequent first.

    Each task counts the strings of all its texts and reports ``most`` of them, of at most
    ``longest`` bytes, as one row; reports are merged FAN at a time until the driver gets no more
    than FAN. Nothing is shuffled by string. The choice may depend on how rows lie in partitions;
    results that are built on it must not.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                if text:
                    seen.update(units(text))
                    if len(seen) > COUNTED:
                        seen = Counter(dict(seen.most_common(COUNTED // 2)))
        yield _report(Counter({w: n for w, n in seen.items() if len(w.encode()) <= longest}), most)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for words, counts in zip(batch.column("words").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                seen.update(dict(zip(words, counts, strict=True)))
        yield _report(seen, most)

    schema = "words array<string>, counts array<long>"
    reports = materialize(map_batches(docs.select("text"), count, schema).where(F.size("words") > 0), "reports")
    n = reports.count()
    while n > FAN:
        reports = materialize(map_batches(reports.repartition(-(-n // FAN)), merged, schema).where(F.size("words") > 0), "reports")
        n = reports.count()
    total: Counter[str] = Counter()
    for r in reports.toLocalIterator():
        total.update(dict(zip(r["words"], r["counts"], strict=True)))
    return [w for w, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:most]]
