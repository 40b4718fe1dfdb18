"""What the text operators share: tables, staging, Arrow passes over texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zephyrload.session import fresh_path

# Rows of one Arrow batch: texts may be long, so a batch holds few of them.
BATCH_ROWS = 512
BATCH_BYTES = 16 << 20

#: Bytes that separate words of plain white-space splitting are those that
#: ``bytes.split()`` takes: space and 0x09 to 0x0D.
_SEPARATORS = bytes(
    c for c in range(128) if not (0x30 <= c <= 0x39 or 0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A)
)
_PLAIN = bytes.maketrans(
    _SEPARATORS + b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b" " * len(_SEPARATORS) + b"abcdefghijklmnopqrstuvwxyz",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read again: cuts lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, f"llm-{label}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plain_words(data: bytes | None) -> list[bytes]:
    """Lower-cased words of ASCII letters, digits and anything beyond ASCII."""
    return data.translate(_PLAIN).split() if data else []


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet, whatever its letter case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def added_name(keep: list[str], base: str) -> str:
    """``base``, or the same with underscores where a kept column has the name, whatever its letter case."""
    taken = {c.lower() for c in keep}
    while base.lower() in taken:
        base += "_"
    return base


def quoted(name: str) -> Column:
    """A column by its plain name, which may hold dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def placeholders(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The same rows under names that no operator uses, and which name stands for which.

    Operators that add columns of their own along the way work on these and give
    the names back at the end with ``toDF``.
    """
    stands = {c: f"held_{k}_column" for k, c in enumerate(df.columns)}
    return df.toDF(*stands.values()), stands


def bound_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small in rows and bytes, for long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def as_bytes(text: str) -> Column:
    return F.col(text).cast("binary")


def map_texts(
    df: DataFrame,
    text: str,
    keep: list[str],
    fields: list[T.StructField],
    factory: Callable[[], Callable[[list[bytes | None]], list]],
) -> DataFrame:
    """Columns ``keep`` as they are, then what ``factory()`` computes from the texts.

    ``factory`` is called once a task; what it returns gets the texts of a batch
    and gives one list or Arrow array per field. A field whose name is kept already gets underscores.
    """
    bound_batches(df.sparkSession)
    # placeholder names inside the pass: column names may clash or hold dots
    held = [quoted(c).alias(f"kept_{k}") for k, c in enumerate(keep)]
    source = df.select(*held, quoted(text).cast("binary").alias("text_bytes"))
    schema = T.StructType([*(T.StructField(f"kept_{k}", df.schema[c].dataType) for k, c in enumerate(keep)), *fields])
    kinds = [_arrow(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = factory()
        for batch in batches:
            made = compute(batch.column(batch.num_columns - 1).to_pylist())
            arrays = [
                a if isinstance(a, pa.Array) else pa.array(a, type=k)
                for a, k in zip(made, kinds, strict=True)
            ]
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, *arrays], names=schema.names)

    names = list(keep)
    for field in fields:
        names.append(added_name(names, field.name))
    return source.mapInArrow(run, schema).toDF(*names)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def held_out(doc_id: str = "doc_id") -> Column:
    """One fifth of the documents, by the checksum of the id's text; a NULL id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


class WordHashes(dict):
    """64-bit hash of a word, remembered for up to ``most`` words of no more than ``longest`` bytes."""

    def __init__(self, most: int = 600_000, longest: int = 64):
        super().__init__()
        import xxhash

        self.most, self.longest, self.hash = most, longest, xxhash.xxh3_64_intdigest

    def __missing__(self, word: bytes) -> int:
        value = self.hash(word)
        if len(word) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


@lru_cache(maxsize=8)
def per_process(kind: Callable, *arguments):
    """One object of a kind for all tasks of a worker process, so that what it remembers lasts."""
    return kind(*arguments)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values over all bits (a fixed bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def flatten(lists: list[list]) -> tuple[list, np.ndarray]:
    """All members in order, and where each list begins and the last one ends."""
    ends = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(x) for x in lists], out=ends[1:])
    return list(chain.from_iterable(lists)), ends


def vector_sum(parts: DataFrame, width: int, fan: int = 64) -> np.ndarray:
    """Sum of int64 vectors of ``width``, given as (part int, vector binary) rows.

    A tree of grouped sums: parts are numbered by task, so a group of the first level
    holds the vectors of ``fan`` tasks, and the driver adds up the last few. ``width`` is a parameter of
    the caller, so neither grows with the data.
    """
    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(width, np.int64)
        for vector in group.column("vector"):
            total += np.frombuffer(vector.as_py(), np.int64)
        return pa.table({"part": group.column("part").slice(0, 1), "vector": [total.tobytes()]})

    level = parts
    for _ in range(2):
        keyed = level.select((F.col("part") / fan).cast("int").alias("part"), "vector")
        level = keyed.groupBy("part").applyInArrow(lambda group: add(group), "part int, vector binary")
    total = np.zeros(width, np.int64)
    for row in level.toLocalIterator():
        total += np.frombuffer(row.vector, np.int64)
    return total


def bounded_sample(df: DataFrame, by: str, most: int, identity: list[str]) -> DataFrame:
    """At most ``most`` rows of each value of ``by``, numbered by ``nth`` from 1.

    Rows are taken by the hash of ``identity``, so neither order nor partitioning
    changes the choice; rows equal in it count once. Counts are over all rows, and a threshold on the
    hash thins each value to little more than ``most``. Only values and hashes are
    dealt out for that: sizes and chosen hashes are staged, so that their size is known
    and the rows themselves, with their texts, are streamed past them.
    """
    slots = 1 << 30
    value, hash_, nth = (free_name(df, n) for n in ("value", "hash", "nth"))
    keyed = df.withColumns({value: F.col(by), hash_: F.xxhash64(*identity)})
    sizes = stage(df.groupBy(F.col(by).alias("of_value")).agg(F.count("*").alias("size")), "sample-sizes")
    room = F.ceil(F.lit(float(slots)) * (1.2 * most + 100) / F.col("size"))
    slot = F.pmod(F.col("of_hash"), F.lit(slots))
    thinned = (
        keyed.select(F.col(value).alias("value"), F.col(hash_).alias("of_hash"))
        .join(sizes, F.col("value") == F.col("of_value"))
        .where(slot < room)
        .select("of_value", "of_hash")
        .distinct()
    )
    first = Window.partitionBy("of_value").orderBy(slot, "of_hash")
    numbered = thinned.withColumn("of_nth", F.row_number().over(first)).where(F.col("of_nth") <= most)
    chosen = stage(numbered, "sample")
    found = keyed.join(chosen, (F.col(value) == F.col("of_value")) & (F.col(hash_) == F.col("of_hash")))
    return found.select(*[F.col(f"`{c}`") for c in df.columns], F.col("of_nth").alias(nth)).dropDuplicates([by, nth])
