"""Exact dedup by sorting the contents.

Texts are normalised (each run of ASCII white space becomes one space) and
sorted as bytes: sampled splitters deal the rows to ranges, every range is
sorted externally by Spark, and equal texts end up next to each other, within a
range or across the border of two. Neighbours are compared in full. The row
with the smallest id of a run of equal texts stays.

The sort key is a prefix of the normalised bytes, the SHA-256 of all of them and
the id, so splitters are small whatever the texts, and a group of copies of any
size is cut into as many ranges as its rows need. A text moves once. Each task
keeps one text and the ids of at most ``RUN_ROWS`` rows of a run; longer runs go
on in links. Runs that meet at the border of two ranges are linked where their
texts, compared in full by Spark, are equal; the driver gets only the numbers
of these runs (two a range), never a text.

Defined cases: a null text counts as empty, and all empty texts are equal; a
text of white space alone is one space; a null id comes last, so a row without
id stays only where no equal text has one; of rows that repeat id and text
exactly one stays; an empty table gives an empty result; extra columns of any
name are carried along by ``keep_firsts``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from gladwire.llm.common import written

PREFIX = 32
RUN_ROWS = 65_536
_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column | str) -> Column:
    """The bytes that are compared."""
    return F.regexp_replace(F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit("")), _SPACE, " ").cast("binary")


def _sorted(docs: DataFrame, carried: list[str]) -> DataFrame:
    """``digest, text, id, own`` in ranges of the sort key, each range in its order."""
    own = F.struct(*(F.col(f"`{c}`") for c in carried)) if carried else F.lit(None).cast("boolean")
    rows = docs.select(normalised("text").alias("text"), F.col("doc_id").alias("id"), own.alias("own"))
    rows = rows.select(
        F.substring("text", 1, PREFIX).alias("prefix"), F.unhex(F.sha2("text", 256)).alias("digest"), "text", "id", "own"
    )
    key = ["prefix", "digest", F.col("id").asc_nulls_last()]
    return rows.repartitionByRange(*key).sortWithinPartitions(*key).drop("prefix")


class _Range:
    """The runs of equal texts of a range whose rows come in the sorted order.

    Whole runs leave with the batch they end in; the last one stays open.
    """

    def __init__(self, part: int, schema: pa.Schema, most: int):
        self.part, self.schema, self.most, self.number, self.begins = part, schema, most, 0, True
        self.text = self.digest = None
        self.ids: list[pa.Array] = []
        self.own: list[pa.Array] = []
        self.rows, self.linked = 0, False

    def add(self, digests: pa.Array, texts: pa.Array, ids: pa.Array, own: pa.Array):
        """The rows of a batch; gives the runs that end in it."""
        # Neighbours are compared in full, the last row of the batch before included.
        same = np.concatenate([[texts[0].as_py() == self.text], pc.equal(texts[1:], texts[:-1]).to_numpy(False)])
        starts = np.flatnonzero(~same.astype(bool))
        if len(starts):
            tail = int(starts[-1])
            closed = starts[:-1] + self.rows
            if self.rows or tail:
                yield self._runs(
                    np.unique([0, *closed]), [*self.ids, ids[:tail]], [*self.own, own[:tail]],
                    [pa.array([self.digest] * self.rows, pa.binary()), digests[:tail]],
                    texts[0].as_py() if self.text is None else self.text,
                )
            self.ids, self.own, self.rows, self.linked = [], [], 0, False
            self.text, self.digest = texts[tail].as_py(), digests[tail].as_py()
            ids, own = ids[tail:], own[tail:]
        while self.rows + len(ids) > self.most:
            room = self.most - self.rows
            self._hold(ids[:room], own[:room])
            yield self.open_run(last=False)
            self.linked = True
            ids, own = ids[room:], own[room:]
        self._hold(ids, own)

    def _hold(self, ids: pa.Array, own: pa.Array) -> None:
        self.ids.append(ids)
        self.own.append(own)
        self.rows += len(ids)

    def open_run(self, last: bool) -> pa.RecordBatch:
        """The rows of the open run so far, as one link of it."""
        found = self._runs(
            np.array([0]), self.ids, self.own, [pa.array([self.digest] * self.rows, pa.binary())],
            self.text, self.text if last else None,
        )
        self.ids, self.own, self.rows = [], [], 0
        return found

    def _runs(self, starts, ids, own, digests, first_text, last_text=None) -> pa.RecordBatch:
        """The texts of the first and the last run of the range stand on their first rows."""
        ids, own, digests = (pa.concat_arrays(x) for x in (ids, own, digests))
        n, runs = len(ids), len(starts)
        sizes = np.diff([*starts, n])
        is_first = np.zeros(n, bool)
        is_first[starts] = True
        linked = np.repeat([self.linked] + [False] * (runs - 1), sizes)
        edge = [None] * n
        if self.begins:
            edge[0] = first_text
        if last_text is not None:
            edge[starts[-1]] = last_text
        columns = [
            ids, own, digests, pa.array(np.full(n, self.part, np.int32)),
            pa.array(np.repeat(np.arange(self.number, self.number + runs), sizes)), pa.array(is_first),
            pa.array(np.repeat(sizes, sizes)), ids.take(pa.array(np.repeat(starts, sizes))),
            pa.array(linked), pa.array(edge, pa.binary()),
        ]
        self.number, self.linked, self.begins = self.number + runs, False, False
        return pa.RecordBatch.from_arrays(columns, schema=self.schema)


def _marked(docs: DataFrame, carried: list[str]) -> DataFrame:
    """Every row with its run, counted within its range; written."""
    rows = _sorted(docs, carried)
    schema = StructType.fromDDL(
        "id long, own boolean, digest binary, part int, run long, is_first boolean, size long, "
        "first long, linked boolean, edge binary"
    )
    schema["id"].dataType = schema["first"].dataType = rows.schema["id"].dataType
    schema["own"].dataType = rows.schema["own"].dataType
    arrow, most = to_arrow_schema(schema), RUN_ROWS

    def mark(batches):
        own_range = _Range(TaskContext.get().partitionId(), arrow, most)
        for batch in batches:
            if batch.num_rows:
                digests, texts, ids, own = (batch.column(i) for i in range(4))
                yield from own_range.add(
                    digests, texts, ids.cast(arrow.field("id").type), own.cast(arrow.field("own").type)
                )
        if own_range.rows:
            yield own_range.open_run(last=True)

    return written(rows.mapInArrow(mark, schema), "copies")


def _links(marked: DataFrame) -> DataFrame:
    """``part, run, g_part, g_run``: runs that go on from another one, and the run they begin with.

    At most two runs a range, and one for ``RUN_ROWS`` rows of a longer run.
    """
    spark = marked.sparkSession
    heads = marked.filter("is_first and (linked or edge is not null)")
    ends = sorted(tuple(r) for r in heads.select("part", "run", "linked").collect())
    outer = {}
    for part, run, _ in ends:
        outer.setdefault(part, [run, run])[1] = run
    parts = sorted(outer)
    borders = [(a, outer[a][1], b, outer[b][0]) for a, b in zip(parts, parts[1:], strict=False)]
    pairs = spark.createDataFrame(borders, "a int, a_run long, b int, b_run long")
    edges = heads.filter("edge is not null").select("part", "run", "edge")
    left, right = (edges.select(F.col("part").alias(p), F.col("run").alias(f"{p}_run"), F.col("edge").alias(f"{p}_edge")) for p in "ab")
    met = F.broadcast(pairs).join(left, ["a", "a_run"]).join(right, ["b", "b_run"])
    equal = {(r["b"], r["b_run"]) for r in met.filter("a_edge = b_edge").select("b", "b_run").collect()}
    before = {(b, b_run): (a, a_run) for a, a_run, b, b_run in borders if (b, b_run) in equal}
    head, rows = {}, []
    for part, run, linked in ends:
        old = (part, run - 1) if linked else before.get((part, run))
        if old is not None:
            head[part, run] = head.get(old, old)
            rows.append((part, run, *head[part, run]))
    # The run they begin with belongs to the group too.
    rows += [(*h, *h) for h in sorted(set(head.values()))]
    return spark.createDataFrame(rows, "part int, run long, g_part int, g_run long")


def grouped(docs: DataFrame, carried: list[str] | None = None) -> DataFrame:
    """``id, own, digest, keep_id, group_size, kept`` of every row; ``own`` holds the carried columns."""
    marked = _marked(docs, carried or [])
    links = _links(marked)
    # Links are few (see above), and so are the groups made of them.
    sizes = marked.filter("is_first").join(F.broadcast(links), ["part", "run"])
    head = (F.col("part") == F.col("g_part")) & (F.col("run") == F.col("g_run"))
    whole = sizes.groupBy("g_part", "g_run").agg(
        F.sum("size").alias("g_size"), F.first(F.when(head, F.col("first")), ignorenulls=True).alias("g_first")
    )
    groups = written(links.join(F.broadcast(whole), ["g_part", "g_run"]), "copy-links")
    joined = marked.drop("edge", "linked").join(F.broadcast(groups), ["part", "run"], "left")
    single = F.col("g_size").isNull()
    return joined.select(
        "id", "own", "digest", F.when(single, F.col("first")).otherwise(F.col("g_first")).alias("keep_id"),
        F.when(single, F.col("size")).otherwise(F.col("g_size")).alias("group_size"),
        (F.col("is_first") & (single | head)).alias("kept"),
    )


def copies(docs: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row of ``doc_id, text``."""
    return grouped(docs).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def keep_firsts(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns as they were."""
    kept = grouped(docs, docs.columns).filter("kept")
    return kept.select(*(F.col("own").getField(c).alias(c) for c in docs.columns))
