"""A collection: one Parquet table at a path, changed snapshot by snapshot.

``path/data/_commit=N-id/_group=G/`` holds the rows written by commit N, grouped by a
hash of the key; ``path/changes/`` in the same layout holds rows that replace or delete
earlier rows of their key. ``path/log/v=N/`` lists, as rows, the folders that make up
snapshot N together with the schema. A commit writes its data first and its log
entry last. A collection has one writer at a time: a later writer that finds its
number taken fails, but two that commit in the same moment are not kept apart.

An insert only adds files; updates, upserts and deletes only add change rows, in
proportion to their batch. A read lays the last change of a key over the rows that are
older, in the key groups that have changes; the others are read as they are. After
``FOLD_AFTER`` commits with changes, and by ``optimize``, the groups they touch are
rewritten without them.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import AlreadyExists, InvalidArgument, NotFound, NotSupported
from ..functions.metrics import closest_first
from ..functions.predicates import predicate
from ..functions.quantize import HalfQuantizer, Quantizer, trained
from ..operators import ddl, stats, writes
from ..operators.fetch import fetch
from ..operators.hamming import hamming_join
from ..operators.layout import interleaved_key
from ..operators.knn_join import as_mips, fold_queries, knn_join, largest_norm
from ..operators.search import DOC_ID, knn, knn_bits
from ..operators.tiles import rank_hits
from ..schema import Field, Index, Schema, schema_from_json, schema_to_json
from ..session import settle
from ..types import is_bits, is_sparse
from .records import PRESENT, conform_records, error_column

GROUP = "_group"
LOG_SCHEMA = "facts string, part string, v int"
#: What a change row does, and the commit that wrote a row.
OP, SEQUENCE = "_op", "_seq"
#: Mark of a folder of changes in the log.
CHANGE = "~"
FOLD_AFTER = 16


@dataclass(frozen=True)
class Snapshot:
    version: int
    schema: Schema
    parts: tuple[str, ...]
    digits: int
    next_id: int
    applied: dict = field(default_factory=dict)
    indexes: dict = field(default_factory=dict)
    changes: tuple[str, ...] = ()
    #: Columns whose name in the files is another one, and names that dropped columns have there.
    stored: dict = field(default_factory=dict)
    retired: tuple[str, ...] = ()

    def column(self, name: str) -> str:
        """The name of a field in the files."""
        return self.stored.get(name, name)


@dataclass(frozen=True)
class IndexState:
    """Key groups rewritten since an index was built; folders it has, lacks, and changes it does not know."""

    rewritten: tuple[str, ...]
    valid: tuple[str, ...]
    fresh: tuple[str, ...]
    changes: tuple[str, ...]


class Collection:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        #: What became of each record given to :meth:`create`.
        self.load_results: DataFrame | None = None

    # -- lifecycle -----------------------------------------------------------

    @classmethod
    def create(
        cls,
        spark: SparkSession,
        path: str,
        schema: Schema,
        records: DataFrame | None = None,
        *,
        group_digits: int = 1,
        rejects: str = "fail",
    ) -> "Collection":
        """Validate the schema and start a collection; fail if one is there.

        ``group_digits`` hex digits of the key hash make 16 ** digits groups: aim
        for a few GB each. If any record cannot be stored, nothing is created, unless
        ``rejects`` is ``report``: then ``load_results`` has a row for every record.
        """
        if rejects not in ("fail", "report"):
            raise InvalidArgument("rejects must be 'fail' or 'report'")
        _checked(schema)
        self = cls(spark, path)
        if self._versions():
            raise AlreadyExists(f"collection already exists at '{path}'")
        first = Snapshot(0, schema, (), group_digits, 0)
        done = None if records is None else self._judged(first, records, "insert", None)
        if done is not None and rejects == "fail":
            bad = done.where("code <> 'ok'").select("message").limit(1).collect()
            if bad:
                raise InvalidArgument(f"a record cannot be stored: {bad[0]['message']}")
        self._log(first)
        if done is not None:
            self._append(first, self._with_ids(done.where("code = 'ok'"), first))
            self.load_results = _result_rows(done, schema.pk)
        return self

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> "Collection":
        self = cls(spark, path)
        if not self._versions():
            raise NotFound(f"no collection at '{path}'")
        return self

    @property
    def schema(self) -> Schema:
        return self.snapshot().schema

    def snapshot(self, version: int | None = None) -> Snapshot:
        number = max(self._versions()) if version is None else version
        rows = self.spark.read.schema(LOG_SCHEMA).json(f"{self.path}/log").where(F.col("v") == number)
        found = rows.collect()  # one row per folder of the snapshot
        if not found:
            raise NotFound(f"no version {number} at '{self.path}'")
        facts = json.loads(found[0]["facts"])
        return Snapshot(
            number,
            schema_from_json(facts["schema"]),
            tuple(sorted(r["part"] for r in found if r["part"] and not r["part"].startswith(CHANGE))),
            facts["digits"],
            facts["next_id"],
            facts["applied"],
            facts["indexes"],
            tuple(sorted(r["part"][len(CHANGE) :] for r in found if r["part"] and r["part"].startswith(CHANGE))),
            facts.get("stored", {}),
            tuple(facts.get("retired", ())),
        )

    def scan(self, version: int | None = None, *, internal: bool = False) -> DataFrame:
        """Current rows; ``internal`` keeps the document id and the key group."""
        snap = self.snapshot(version)
        df = self._rows(snap)
        return df if internal else df.drop(GROUP, DOC_ID)

    # -- documents -----------------------------------------------------------

    def insert(self, batch: DataFrame, *, order: Sequence[str] | None = None) -> DataFrame:
        snap = self.snapshot()
        done = self._judged(snap, batch, "insert", order)
        new = done.where("code = 'ok'")
        self._append(snap, self._with_ids(new, snap))
        return _result_rows(done, snap.schema.pk)

    def update(self, batch: DataFrame, *, order: Sequence[str] | None = None) -> DataFrame:
        snap = self.snapshot()
        done = self._judged(snap, batch, "update", order)
        good = done.where("code = 'ok'")
        given = [c for c in snap.schema.names() if c in batch.columns]
        extra = [c for c in (PRESENT, "_pos") if c in good.columns]
        held = self._rows(snap, self._groups(good)).drop(GROUP).join(good.select(snap.schema.pk), snap.schema.pk, "left_semi")
        self._change(snap, writes.patched(held, good.select(*given, *extra), snap.schema.pk))
        return _result_rows(done, snap.schema.pk)

    def upsert(
        self,
        batch: DataFrame,
        *,
        order: Sequence[str] | None = None,
        newest: bool = False,
        applied: dict | None = None,
    ) -> DataFrame:
        """Insert or overwrite; the last row of a key by ``order`` wins.

        With ``newest`` a stored row that is later by the ``order`` fields also
        wins over the batch, so late batches cannot set a document back.
        """
        snap = self.snapshot()
        pk = snap.schema.pk
        done = self._judged(snap, batch, "upsert", order)
        last = writes._one_per_key(done.where("code = 'ok'"), pk, last=True)

        if newest and not order:
            raise InvalidArgument("newest needs the order fields")

        stored = F.struct(*[F.col(c) for c in order]) if newest else F.lit(None)
        base = self._rows(snap, self._groups(last)).drop(GROUP)
        held = base.select(pk, F.col(DOC_ID).alias("_old"), stored.alias("_stored"))
        known = last.join(held, pk, "left")
        if newest:
            later = F.col("_stored") > F.struct(*[F.col(c) for c in order])
            known = known.where(~F.coalesce(later, F.lit(False)))
        # Settled: ids are given to the new keys, and both halves are written.
        known = settle(known.drop("_stored"), self.spark)
        old = known.where("_old is not null").withColumn(DOC_ID, F.col("_old")).drop("_old")
        new = self._with_ids(known.where("_old is null").drop("_old"), snap)
        self._change(snap, writes._like(old, base).unionByName(writes._like(new, base)), applied=applied)
        return _result_rows(done, pk)

    def delete(self, keys: DataFrame, *, order: Sequence[str] | None = None) -> DataFrame:
        snap = self.snapshot()
        pk = snap.schema.pk
        named = keys.withColumn(GROUP, writes.key_group(pk, snap.digits))
        done = settle(writes.classify_delete(self._rows(snap, self._groups(named)), named, pk=pk, order=order))
        self._change(snap, gone=done.where("code = 'ok'").select(pk))
        return _result_rows(done, pk)

    def delete_by_filter(self, condition: str) -> None:
        snap = self.snapshot()
        base = self._rows(snap)
        hit = predicate(base, condition, columns=snap.schema.names())
        if hit is None:
            raise InvalidArgument("filter must be set")
        self._change(snap, gone=base.where(hit).select(snap.schema.pk))

    def fetch(self, keys: DataFrame, *, position: str = "pos") -> DataFrame:
        """Documents for ``(position, key)`` rows; only their key groups are read."""
        snap = self.snapshot()
        pk = snap.schema.pk
        groups = self._groups(keys.withColumn(GROUP, writes.key_group(pk, snap.digits)))
        rows = self._rows(snap, groups).drop(GROUP, DOC_ID)
        return fetch(rows, keys, pk=pk, position=position)

    def search(
        self,
        field: str,
        vector: Sequence[float],
        *,
        metric: str | None = None,
        late_fetch: bool = False,
        n_probe: int | None = None,
        ef: int | None = None,
        **options,
    ) -> DataFrame:
        """Exact search; the metric defaults to the field's index, else l2.

        With ``n_probe`` or ``ef`` the field's index is searched, as in
        :meth:`search_many`, and the output fields of the hits are joined.
        ``late_fetch`` first finds the k keys from the key, vector and filter
        columns alone, then reads the output fields from those keys' groups only:
        worth it when the output fields are wide.
        """
        snap = self.snapshot()
        if field in snap.schema and is_bits(snap.schema[field].type):
            return self._search_bits(snap, snap.schema[field], vector, metric, n_probe is not None or ef is not None, late_fetch, options)
        declared = self._vector_field(snap, field)
        if len(vector) != declared.dimension:
            raise InvalidArgument(
                f"query vector has dimension {len(vector)}, expected {declared.dimension}"
            )
        pk = snap.schema.pk
        options["metric"] = metric or _metric(declared)
        self._check_filter(snap, options.get("filter"))
        rows = self._rows(snap).drop(GROUP)
        if n_probe is not None or ef is not None:
            one = self.spark.createDataFrame([(0, [float(x) for x in vector])], "qid int, v array<double>")
            asked = {c: options[c] for c in ("k", "filter", "radius") if c in options}
            found = self.search_many(
                one, field, qid="qid", query_field="v", metric=options["metric"], n_probe=n_probe, ef=ef, **asked
            ).select(F.col("pk").alias(pk), "score")
            columns = knn(rows, field, vector, pk=pk, **options).columns
            order = closest_first(options["metric"], F.col("score"))
            found = settle(found, self.spark)
            return found.join(self._rows_of(snap, found), pk).select(columns).orderBy(order, F.col(pk).asc())
        if not late_fetch:
            return knn(rows, field, vector, pk=pk, **options)
        full = knn(rows, field, vector, pk=pk, **options)
        narrow = {k: v for k, v in options.items() if k not in ("include_vector", "include_doc_id")}
        narrow["output_fields"] = [pk]
        found = knn(rows, field, vector, pk=pk, **narrow).select(pk, "score").collect()  # k rows
        hits = self.spark.createDataFrame(found, full.select(pk, "score").schema)
        keyed = hits.withColumn(GROUP, writes.key_group(pk, snap.digits))
        wanted = self._rows(snap, self._groups(keyed)).where(
            F.col(pk).isin([r[pk] for r in found])
        )
        order = closest_first(options["metric"], F.col("score"))
        return hits.join(wanted, pk).select(full.columns).orderBy(order, F.col(pk).asc())

    def _search_bits(self, snap: Snapshot, declared: Field, bits: bytes, metric, probed: bool, late_fetch: bool, options: dict) -> DataFrame:
        if probed or late_fetch:
            raise NotSupported("searches of bit vectors are exact scans of their column")
        if len(bits) != -(-declared.dimension // 8):
            raise InvalidArgument(f"query vector has {8 * len(bits)} bits, expected {declared.dimension}")
        self._check_filter(snap, options.get("filter"))
        rows = self._rows(snap).drop(GROUP)
        return knn_bits(rows, declared.name, bytes(bits), pk=snap.schema.pk, metric=metric or _metric(declared), **options)

    def search_many(
        self,
        queries: DataFrame,
        field: str,
        *,
        qid: str,
        query_field: str | None = None,
        k: int = 10,
        metric: str | None = None,
        filter: str | None = None,
        n_probe: int | None = None,
        ef: int | None = None,
        scale_factor: float = 2.0,
        linear: bool = False,
        radius: float | None = None,
        output_fields: Sequence[str] | None = None,
        include_vector: bool = False,
        include_doc_id: bool = False,
    ) -> DataFrame:
        """Rows ``(qid, rank, pk, score)`` for a table of query vectors.

        ``radius`` drops hits that are farther, ``output_fields`` adds fields of the hits,
        ``include_vector`` and ``include_doc_id`` their vector and document id. These are
        read from the key groups of the hits alone.
        With an index table its nearest cells are searched (``n_probe`` of them, or
        enough to hold ``ef`` members); rows written since it was built are searched
        exactly, so nothing new is missed and nothing deleted comes back. A quantized
        index finds ``k * scale_factor`` candidates that the original vectors rank.
        Without an index, or with ``linear``, the search is exact.
        """
        snap = self.snapshot()
        bits = field in snap.schema and is_bits(snap.schema[field].type)
        chosen = metric or _metric(snap.schema[field] if bits else self._vector_field(snap, field))
        if bits and (chosen != "l2" or n_probe is not None or ef is not None):
            raise NotSupported("tables of bit vectors are joined exactly, by l2")
        found = self._bit_hits(snap, queries, field, qid, query_field, k, filter) if bits else self._hits(
            snap, queries, field, chosen, qid=qid, query_field=query_field, k=k, filter=filter,
            n_probe=n_probe, ef=ef, scale_factor=scale_factor, linear=linear,
        )
        if radius is not None:
            found = found.where(F.col("score") >= radius if chosen == "ip" else F.col("score") <= radius)
        wanted = list(dict.fromkeys([*(output_fields or ()), *[field] * include_vector, *[DOC_ID] * include_doc_id]))
        if not wanted:
            return found
        unknown = [c for c in wanted if c not in snap.schema and c != DOC_ID]
        if unknown:
            raise InvalidArgument(f"unknown output field '{unknown[0]}'")
        pk, found = snap.schema.pk, settle(found, self.spark)
        rows = self._rows_of(snap, found.select(F.col("pk").alias(pk))).select(F.col(pk).alias("pk"), *[F.col(c).alias(c) for c in wanted])
        return found.join(rows, "pk").select("qid", "rank", "pk", "score", *wanted)

    def _rows_of(self, snap: Snapshot, hits: DataFrame) -> DataFrame:
        """The rows of the key groups that ``hits`` (settled, with the key) fall in."""
        keyed = hits.withColumn(GROUP, writes.key_group(snap.schema.pk, snap.digits))
        return self._rows(snap, self._groups(keyed)).drop(GROUP)

    def _check_filter(self, snap: Snapshot, condition) -> None:
        """A filter names today's columns; an index may still hold dropped ones."""
        if condition is not None:
            predicate(self._rows(snap, set()), condition, columns=snap.schema.names())

    def _bit_hits(self, snap: Snapshot, queries, field, qid, query_field, k, filter) -> DataFrame:
        self._check_filter(snap, filter)
        rows = self._rows(snap).drop(GROUP)
        return hamming_join(queries, rows, qid=qid, pk=snap.schema.pk, field=field, query_field=query_field, k=k, filter=filter)

    def _hits(
        self, snap: Snapshot, queries, field, chosen, *, qid, query_field, k, filter, n_probe, ef, scale_factor, linear
    ) -> DataFrame:
        from ..operators import index as ivf

        pk = snap.schema.pk
        self._check_filter(snap, filter)
        shape = dict(qid=qid, pk=pk, field=field, query_field=query_field, k=k)
        facts = snap.indexes.get(field)
        if facts is None or linear or facts["metric"] != chosen:
            rows = self._rows(snap).drop(GROUP)
            return knn_join(queries, rows, metric=chosen, filter=filter, **shape)
        state = self._index_state(snap, facts)
        scan = dict(metric=chosen, filter=filter, **shape)
        if not state.valid:
            # After a change of the schema the index has nothing current to give.
            return knn_join(queries, self._rows(snap).drop(GROUP), **scan)
        table, cells = self._index(facts)
        table = self._renamed(snap, facts, table)
        if filter is not None and not self._covers(table, filter):
            return knn_join(queries, self._rows(snap).drop(GROUP), **scan)
        table, known = self._current(snap, table, state), None
        if facts.get("stats"):  # else the index is older than these statistics and is measured
            known = ivf.StoredStats.read(self.spark, f"{facts['table']}/cells/{ivf.STATS}", grouped=True)
            known = replace(known, sketches=self._renamed(snap, facts, known.sketches))
            known = known.lacking(state.rewritten, loose=bool(state.changes))
        top = None
        if chosen == "mipsl2":
            # Parts are merged by the product; the score refers to today's largest norm.
            cells = replace(cells, metric="ip")
            top = largest_norm(self._rows(snap), field, cells.dimension)
        if facts["quantize"]:
            found = ivf.ivf_knn_refined(
                queries,
                table,
                self._rows(snap),
                cells,
                self._quantizer(facts),
                scale_factor=scale_factor,
                n_probe=n_probe,
                ef=ef,
                filter=filter,
                stats=known,
                **shape,
            )
        elif ef is not None:
            found = ivf.ann_knn(queries, table, cells, ef=ef, filter=filter, stats=known, **shape)
        else:
            found = ivf.ivf_knn(queries, table, cells, n_probe=n_probe, filter=filter, stats=known, **shape)
        if state.rewritten or state.fresh or state.changes:
            rows = self._fresh(snap, state, facts["version"]).drop(GROUP)
            new = knn_join(queries, rows, metric=cells.metric, filter=filter, **shape)
            found = rank_hits(found.drop("rank").unionByName(new.drop("rank")), k, cells.metric)
        if top is None:
            return found
        asked = queries.select(F.col(qid).alias("qid"), F.col(query_field or field).alias("vector"))
        return as_mips(found, fold_queries(asked, cells.dimension), top)

    def _index_state(self, snap: Snapshot, facts: dict) -> "IndexState":
        """What of an index still holds, and what it lacks."""
        then = self.snapshot(facts["version"])
        built = set(then.parts)
        # A group that lost a folder was rewritten: all its current rows are fresh.
        rewritten = sorted({self._group_of(p) for p in built - set(snap.parts)})
        kept = [p for p in snap.parts if self._group_of(p) not in rewritten]
        changes = [c for c in snap.changes if c not in then.changes and self._group_of(c) not in rewritten]
        return IndexState(tuple(rewritten), tuple(p for p in kept if p in built), tuple(p for p in kept if p not in built), tuple(changes))

    def _current(self, snap: Snapshot, table: DataFrame, state: "IndexState") -> DataFrame:
        """The rows of an index table that no later write has touched."""
        pk = snap.schema.pk
        if state.rewritten:
            table = table.where(~writes.key_group(pk, snap.digits).isin(list(state.rewritten)))
        if state.changes:
            table = table.join(self._files(snap, "changes", state.changes).select(pk), pk, "left_anti")
        return table

    def _fresh(self, snap: Snapshot, state: "IndexState", version: int) -> DataFrame:
        """Current rows that an index of a version lacks."""
        rows = self._rows(snap, set(state.rewritten))
        groups = {self._group_of(c) for c in state.changes} | {self._group_of(p) for p in state.fresh}
        return rows.unionByName(self._laid(snap, state.fresh, self._of(snap.changes, groups - set(state.rewritten)), since=version))

    @staticmethod
    def _covers(table: DataFrame, condition: str) -> bool:
        """Whether the index table has all columns that the condition names."""
        try:
            predicate(table, condition)
        except InvalidArgument as unknown:
            if "unknown column" in str(unknown):
                return False
            raise
        return True

    @staticmethod
    def _vector_field(snap: Snapshot, field: str) -> Field:
        declared = snap.schema[field]
        if not declared.is_vector or is_sparse(declared.type) or is_bits(declared.type):
            raise InvalidArgument(f"field '{field}' is not a dense vector field")
        return declared

    # -- schema changes ------------------------------------------------------

    def add_column(self, new: Field, default: str | None = None) -> None:
        """A nullable column without a default only enters the log: older files read as null."""
        snap = self.snapshot()
        schema = _checked(replace(snap.schema, fields=(*snap.schema.fields, new)))
        if new.nullable and default is None:
            taken = {*snap.retired, *(snap.column(c) for c in snap.schema.names())}
            name = new.name if new.name not in taken else f"{new.name}@{snap.version + 1}"
            stored = snap.stored if name == new.name else {**snap.stored, new.name: name}
            self._log(replace(snap, version=snap.version + 1, schema=schema, stored=stored))
            return
        if not new.nullable:
            _no_nulls(ddl.add_column(self._rows(snap), new, default), new.name)
        self._rewrite_all(snap, schema, lambda df: ddl.add_column(df, new, default))

    def drop_column(self, name: str) -> None:
        """Only the log changes: files keep the column, no reader asks for it."""
        snap = self.snapshot()
        if name == snap.schema.pk:
            raise InvalidArgument("the primary key cannot be dropped")
        fields = tuple(f for f in snap.schema.fields if f.name != name)
        retired = (*snap.retired, snap.column(name)) if name in snap.schema else snap.retired
        indexes = {k: v for k, v in snap.indexes.items() if k != name}
        stored = {k: v for k, v in snap.stored.items() if k != name}
        schema = replace(snap.schema, fields=fields)
        self._log(replace(snap, version=snap.version + 1, schema=schema, indexes=indexes, stored=stored, retired=retired))

    def rename_column(self, name: str, new_name: str) -> None:
        """Only the log changes: files and indexes keep the old name, and readers look there."""
        snap = self.snapshot()
        ddl.rename_column(self._rows(snap, set()), name, new_name)  # the rules of a rename
        fields = tuple(
            replace(f, name=new_name) if f.name == name else f for f in snap.schema.fields
        )
        schema = _checked(replace(snap.schema, fields=fields))
        stored = {k: v for k, v in snap.stored.items() if k != name} | {new_name: snap.column(name)}
        stored = {k: v for k, v in stored.items() if k != v}

        def renamed(facts: dict) -> dict:
            keep = facts.get("keep")
            return {**facts, "keep": keep and [new_name if c == name else c for c in keep]}

        indexes = {new_name if k == name else k: renamed(v) for k, v in snap.indexes.items()}
        self._log(replace(snap, version=snap.version + 1, schema=schema, indexes=indexes, stored=stored))

    def cast_column(self, new: Field) -> DataFrame:
        """Change type, nullability or dimension; returns the rows that failed."""
        snap = self.snapshot()
        fields = tuple(new if f.name == new.name else f for f in snap.schema.fields)
        schema = replace(snap.schema, fields=fields).validate()
        changed, errors = ddl.cast_column(self._rows(snap), new)
        if not new.nullable:
            _no_nulls(changed, new.name)
        self._rewrite_all(snap, schema, lambda df: ddl.cast_column(df, new)[0])
        return errors.drop(GROUP, DOC_ID)

    # -- indexes and maintenance ---------------------------------------------

    def create_index(self, name: str, index: Index, *, keep: Sequence[str] | None = None, cells=None) -> None:
        """Record an index on a field; vector indexes other than flat build a table.

        ``cells`` are trained centroids to use instead of new ones.
        """
        from ..operators import index as ivf

        snap = self.snapshot()
        fields = tuple(replace(f, index=index) if f.name == name else f for f in snap.schema.fields)
        schema = replace(snap.schema, fields=fields).validate()
        indexes = dict(snap.indexes)
        number = snap.version + 1
        if index.type in ("ivf", "hnsw"):
            if is_sparse(schema[name].type) or is_bits(schema[name].type):
                raise NotSupported(f"field '{name}': cells are for dense vectors; bit vectors are searched exactly without an index")
            df = self._rows(snap).drop(GROUP, DOC_ID)
            cells = cells or ivf.train_centroids(
                df,
                name,
                n_list=index.n_list or ivf.N_LIST,
                n_iters=index.n_iters or ivf.N_ITERS,
                metric=index.metric or "l2",
            )
            scalars = list(keep) if keep is not None else snap.schema.names("forward")
            rows = df.select(*dict.fromkeys([snap.schema.pk, *scalars, name]))
            # A name of its own: an abandoned build is never taken for this one.
            table = f"{self.path}/index/{name}/v={number}-{uuid.uuid4().hex[:8]}"
            quantizer = None
            placed = ivf.assign(rows, name, cells, soar=bool(index.use_soar))
            if index.quantize:
                quantizer = trained(df, name, index.quantize, cells.dimension)
                placed = ivf.quantized(placed, name, quantizer)
            ivf.write_index(placed, f"{table}/cells", group=writes.key_group(snap.schema.pk, snap.digits), columns=[c for c in scalars if c != snap.schema.pk])
            if isinstance(quantizer, Quantizer):
                ranges = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(quantizer.lo, quantizer.hi))]
                stored = self.spark.createDataFrame(ranges, "dim int, lo double, hi double")
                stored.coalesce(1).write.parquet(f"{table}/ranges")
            cells.table(self.spark).coalesce(1).write.parquet(f"{table}/centroids")
            indexes[name] = {
                "table": table,
                "version": snap.version,
                "quantize": index.quantize,
                "metric": cells.metric,
                "dimension": cells.dimension,
                "max_norm": cells.max_norm,
                "keep": None if keep is None else list(keep),
                "stats": True,
                "names": {c: snap.column(c) for c in rows.columns},
            }
        self._log(replace(snap, version=number, schema=schema, indexes=indexes))

    def drop_index(self, name: str) -> None:
        """Forget an index; searches on the field go back to the exact scan."""
        snap = self.snapshot()
        fields = tuple(replace(f, index=None) if f.name == name else f for f in snap.schema.fields)
        indexes = {k: v for k, v in snap.indexes.items() if k != name}
        schema = replace(snap.schema, fields=fields)
        self._log(replace(snap, version=snap.version + 1, schema=schema, indexes=indexes))

    def index(self, name: str):
        """``(index table, centroids)`` of an indexed vector field."""
        snap = self.snapshot()
        facts = snap.indexes.get(name)
        if facts is None:
            raise NotFound(f"field '{name}' has no index table")
        table, cells = self._index(facts)
        return self._renamed(snap, facts, table), cells

    @staticmethod
    def _renamed(snap: Snapshot, facts: dict, table: DataFrame) -> DataFrame:
        """An index's table with today's names of its columns, without those of dropped ones."""
        names = facts.get("names", {})
        now = {snap.column(c): c for c in snap.schema.names()}
        if all(now.get(column) == then for then, column in names.items()):
            return table
        kept = [(c, now.get(names[c]) if c in names else c) for c in table.columns]
        return table.select(*[F.col(f"`{c}`").alias(name) for c, name in kept if name is not None])

    def _index(self, facts: dict):
        from ..operators.index import Centroids

        rows = self.spark.read.parquet(f"{facts['table']}/centroids").orderBy("cell").collect()
        points = np.array([r["centroid"] for r in rows])
        cells = Centroids(points, facts["metric"], facts["dimension"], facts["max_norm"])
        return self.spark.read.parquet(f"{facts['table']}/cells"), cells

    def _quantizer(self, facts: dict):
        if facts["quantize"] == "fp16":
            return HalfQuantizer(facts["dimension"])
        rows = self.spark.read.parquet(f"{facts['table']}/ranges").orderBy("dim").collect()
        lo, hi = ([r[c] for r in rows] for c in ("lo", "hi"))
        return Quantizer(facts["quantize"], np.array(lo), np.array(hi))

    def optimize(
        self, sort_by: Sequence[str] | None = None, *, retrain: bool = False, group_digits: int | None = None, interleave: bool = False
    ) -> None:
        """Rewrite the snapshot as few sorted files and rebuild index tables.

        With ``interleave`` rows lie along a space-filling key of the sort fields instead of
        in their order, so that a filter on any one of them skips row groups.

        Trained cells are used again, unless ``retrain`` or a vector has outgrown the norm
        that ip and mipsl2 cells were trained for. ``group_digits`` changes the number of
        key groups.
        """
        snap = self.snapshot()
        keys = list(sort_by or snap.schema.names("indexed"))
        keys = [c for c in keys if not snap.schema[c].is_vector]
        if group_digits is not None:
            snap = replace(snap, digits=group_digits)
        if interleave and keys:
            keys = [interleaved_key(self._rows(snap), keys), *keys]
        self._rewrite_all(snap, snap.schema, lambda df: df, sort_by=[*keys, snap.schema.pk])
        for name, facts in snap.indexes.items():
            keep = facts.get("keep")
            held = None if keep is None else [c for c in keep if c in snap.schema]
            cells = None if retrain else self._index(facts)[1]
            if cells is not None and cells.max_norm is not None:
                now = self.snapshot()
                if largest_norm(self._rows(now), name, cells.dimension) > cells.max_norm:
                    cells = None
            self.create_index(name, snap.schema[name].index, keep=held, cells=cells)

    def stats(self) -> DataFrame:
        """Rows ``(metric, field, value)``: document count, index completeness."""
        snap = self.snapshot()
        df = self._rows(snap)
        out = stats.doc_count(df).select(
            F.lit("doc_count").alias("metric"),
            F.lit(None).cast("string").alias("field"),
            F.col("doc_count").cast("double").alias("value"),
        )
        for name, facts in snap.indexes.items():
            held = df.where(F.col(name).isNotNull())
            state = self._index_state(snap, facts)
            if state.valid:
                # What a search would not use does not count as indexed.
                table = self._current(snap, self._renamed(snap, facts, self.spark.read.parquet(f"{facts['table']}/cells")), state)
            else:
                table = held.select(snap.schema.pk).limit(0)
            share = stats.index_completeness(held, table, pk=snap.schema.pk)
            out = out.unionByName(
                share.select(
                    F.lit("index_completeness").alias("metric"),
                    F.lit(name).alias("field"),
                    F.col("completeness").alias("value"),
                )
            )
        return out

    # -- internals -----------------------------------------------------------

    def _versions(self) -> list[int]:
        try:
            files = self.spark.read.schema(LOG_SCHEMA).json(f"{self.path}/log").inputFiles()
        except AnalysisException as missing:
            if missing.getCondition() == "PATH_NOT_FOUND":
                return []
            raise
        return sorted({int(n) for f in files for n in re.findall(r"/v=(\d+)/", f)})

    def _log(self, snap: Snapshot) -> None:
        facts = json.dumps(
            {
                "schema": schema_to_json(snap.schema),
                "digits": snap.digits,
                "next_id": snap.next_id,
                "applied": snap.applied,
                "indexes": snap.indexes,
                "stored": snap.stored,
                "retired": snap.retired,
            },
            sort_keys=True,
        )
        folders = F.from_json(F.lit(json.dumps([*snap.parts, *(CHANGE + c for c in snap.changes)])), "array<string>")
        entry = self.spark.range(0, 1, 1, 1).select(
            F.lit(facts).alias("facts"), F.explode_outer(folders).alias("part")
        )
        try:
            entry.write.mode("errorifexists").json(f"{self.path}/log/v={snap.version}")
        except AnalysisException as taken:
            if taken.getCondition() == "PATH_ALREADY_EXISTS":
                raise AlreadyExists(f"version {snap.version} was committed by another writer") from None
            raise

    def _struct(self, schema: Schema) -> T.StructType:
        return T.StructType(
            [
                *schema.to_struct().fields,
                T.StructField(DOC_ID, T.LongType()),
                T.StructField(GROUP, T.StringType()),
            ]
        )

    def _files(self, snap: Snapshot, kind: str, parts: Sequence[str]) -> DataFrame:
        """Rows of folders of ``data`` or ``changes``, with the commit that wrote them."""
        extra = [T.StructField(OP, T.StringType())] if kind == "changes" else []
        struct = T.StructType([*self._struct(snap.schema).fields, *extra])
        if not parts:
            return self.spark.createDataFrame([], struct.add(SEQUENCE, T.LongType()))
        there = [T.StructField(snap.column(f.name), f.dataType) for f in struct.fields]
        reader = self.spark.read.schema(T.StructType([*there, T.StructField("_commit", T.StringType())]))
        base = f"{self.path}/{kind}"
        df = reader.option("basePath", base).parquet(*[f"{base}/{p}" for p in parts])
        sequence = F.substring_index("_commit", "-", 1).cast("long").alias(SEQUENCE)
        return df.select(*[F.col(f"`{snap.column(f.name)}`").alias(f.name, metadata=f.metadata) for f in struct.fields], sequence)

    def _rows(self, snap: Snapshot, groups: set[str] | None = None) -> DataFrame:
        """Current rows, of all or of some key groups."""
        if groups is None:
            return self._laid(snap, snap.parts, snap.changes)
        return self._laid(snap, self._of(snap.parts, groups), self._of(snap.changes, groups))

    def _laid(self, snap: Snapshot, parts: Sequence[str], changes: Sequence[str], since: int = -1) -> DataFrame:
        """Rows of the folders with the changes laid over them; those after commit ``since`` add theirs."""
        struct, pk = self._struct(snap.schema), snap.schema.pk

        def plain(df: DataFrame) -> DataFrame:
            return df.select(*[F.col(f"`{f.name}`").alias(f.name, metadata=f.metadata) for f in struct.fields])

        touched = {self._group_of(c) for c in changes}
        clean = [p for p in parts if self._group_of(p) not in touched]
        rows = plain(self._files(snap, "data", clean))
        if not changes:
            return rows
        every = self._files(snap, "changes", changes)
        # A commit has one change for a key.
        last = every.groupBy(pk).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in every.columns]), SEQUENCE).alias("c"))
        put = last.where(f"c.{OP} = 'put'").where(F.col(f"c.{SEQUENCE}") > since).select("c.*")
        covered = every.groupBy(pk).agg(F.max(SEQUENCE).alias("_last"))
        under = self._files(snap, "data", self._of(parts, touched)).join(covered, pk, "left")
        over = under.where(F.col("_last").isNull() | (F.col(SEQUENCE) > F.col("_last")))
        rest = plain(over).unionByName(plain(put))
        return rest if not clean else rows.unionByName(rest)

    @staticmethod
    def _group_of(part: str) -> str:
        name = part.rsplit("=", 1)[1]
        return "" if name == "__HIVE_DEFAULT_PARTITION__" else name

    @classmethod
    def _of(cls, parts: Sequence[str], groups: set[str]) -> list[str]:
        return [p for p in parts if cls._group_of(p) in groups]

    @staticmethod
    def _groups(rows: DataFrame) -> set[str]:
        # At most 16 ** digits values.
        return {r[0] for r in rows.select(GROUP).distinct().collect() if r[0] is not None}

    def _judged(self, snap: Snapshot, batch: DataFrame, op: str, order) -> DataFrame:
        """Conform, validate and classify a batch; settled, because the snapshot
        and the result rows are both made from it."""
        target = snap.schema
        if op == "update":
            # A patch: only the given fields are judged, none of them is required.
            fields = [f for f in target.fields if f.name in batch.columns]
            target = replace(target, fields=tuple(replace(f, nullable=True) for f in fields))
            if snap.schema.pk not in target:
                raise InvalidArgument("primary key must be set")
        firm = [f.name for f in snap.schema.fields if not f.nullable and not f.primary_key and f.name in batch.columns]
        kept = [c for c in batch.columns if c in target or c == PRESENT]
        rows = writes.sequenced(batch, order).select(*kept, "_pos")
        read = conform_records(rows, target, errors="_unread", carry=["_pos"])
        judged = settle(
            read.withColumn("_bad", F.coalesce("_unread", error_column(read, target), *_given_null(read, firm, op)))
            .withColumn(GROUP, writes.key_group(snap.schema.pk, snap.digits))
            .drop("_unread"),
            self.spark,
        )
        good = judged.where("_bad is null").drop("_bad")
        classify = {
            "insert": writes.classify_insert,
            "update": writes.classify_update,
            "upsert": writes.classify_upsert,
        }[op]
        done = classify(self._rows(snap, set() if op == "upsert" else self._groups(good)), good, pk=snap.schema.pk)
        rejected = judged.where("_bad is not null").select(
            *[c for c in judged.columns if c != "_bad"],
            F.lit(op).alias("op"),
            F.lit("invalid_argument").alias("code"),
            F.col("_bad").alias("message"),
        )
        judged = done.unionByName(rejected)
        # An upsert adds constants only; the others joined the base and are kept.
        return judged if op == "upsert" else settle(judged)

    def _with_ids(self, rows: DataFrame, snap: Snapshot) -> DataFrame:
        return writes.assign_doc_ids(rows, pk=snap.schema.pk, start=snap.next_id, digits=max(snap.digits, 2))

    def _write(
        self, rows: DataFrame, snap: Snapshot, number: int, sort_by: Sequence[str | Column] = (), kind: str = "data"
    ) -> tuple[list[str], int]:
        """Write rows of commit ``number``: the folders that came out and the next id."""
        struct = self._struct(snap.schema)
        if kind == "changes":
            struct = T.StructType([*struct.fields, T.StructField(OP, T.StringType())])
        # A name of its own, so that a writer that loses the race harms nothing.
        commit = f"_commit={number}-{uuid.uuid4().hex[:8]}"
        table = f"{self.path}/{kind}/{commit}"
        # AQE merges small groups and splits large ones after this shuffle.
        top = Observation()
        spread = rows.select(*struct.names).hint("rebalance", F.col(GROUP))
        spread = spread.observe(top, F.max(DOC_ID).alias("id"))
        if sort_by:
            spread = spread.sortWithinPartitions(GROUP, *sort_by)
        spread = spread.select(*[F.col(f"`{c}`").alias(snap.column(c)) for c in struct.names])
        writer = spread.write.mode("errorifexists").partitionBy(GROUP)
        for f in snap.schema.fields:
            if f.index is not None and f.index.type == "invert":
                writer = writer.option(f"parquet.bloom.filter.enabled#{snap.column(f.name)}", "true")
        if snap.schema.max_doc_count_per_segment:
            writer = writer.option("maxRecordsPerFile", snap.schema.max_doc_count_per_segment)
        writer.parquet(table)
        files = self.spark.read.schema(struct).parquet(table).inputFiles()
        groups = {g for f in files for g in re.findall(rf"/{GROUP}=([^/]+)/", f)}
        last = top.get.get("id")
        next_id = snap.next_id if last is None else max(snap.next_id, last + 1)
        return [f"{commit}/{GROUP}={g}" for g in sorted(groups)], next_id

    def _append(self, snap: Snapshot, rows: DataFrame) -> None:
        number = snap.version + 1
        added, next_id = self._write(rows, snap, number)
        self._log(replace(snap, version=number, parts=(*snap.parts, *added), next_id=next_id))

    def _change(self, snap: Snapshot, put: DataFrame | None = None, gone: DataFrame | None = None, *, applied: dict | None = None) -> None:
        """Commit new rows of keys (``put``, whole) or keys that go (``gone``)."""
        struct, number = self._struct(snap.schema), snap.version + 1
        rows = put
        if put is None:
            nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in struct.fields if f.name not in (snap.schema.pk, GROUP)]
            rows = gone.select(snap.schema.pk, *nulls)
        rows = rows.withColumn(GROUP, writes.key_group(snap.schema.pk, snap.digits)).withColumn(OP, F.lit("put" if gone is None else "gone"))
        added, next_id = self._write(rows, snap, number, kind="changes")
        after = replace(snap, version=number, next_id=next_id, applied={**snap.applied, **(applied or {})}, changes=(*snap.changes, *added))
        self._log(after)
        if len({c.split("/", 1)[0] for c in after.changes}) >= FOLD_AFTER:
            self._fold(after)

    def _fold(self, snap: Snapshot) -> None:
        """Rewrite the key groups that have changes, without them."""
        groups = {self._group_of(c) for c in snap.changes}
        rows = self._rows(snap, groups)
        added, _ = self._write(rows, snap, snap.version + 1)
        kept = tuple(p for p in snap.parts if self._group_of(p) not in groups)
        self._log(replace(snap, version=snap.version + 1, parts=(*kept, *added), changes=()))

    def _rewrite_all(self, snap: Snapshot, schema: Schema, change, sort_by: Sequence[str] = ()) -> None:
        number = snap.version + 1
        base = self._rows(snap)
        changed = replace(snap, schema=schema, changes=(), stored={}, retired=())
        rows = change(base.drop(GROUP)).withColumn(GROUP, writes.key_group(schema.pk, snap.digits))
        added, _ = self._write(rows, changed, number, sort_by)
        self._log(replace(changed, version=number, parts=tuple(added)))


def _checked(schema: Schema) -> Schema:
    """Schema rules, plus: names with a leading underscore belong to the table."""
    schema.validate()
    taken = [f.name for f in schema.fields if f.name.startswith("_")]
    if taken:
        raise InvalidArgument(f"field name '{taken[0]}' may not start with an underscore")
    return schema


def _no_nulls(df: DataFrame, name: str) -> None:
    if df.where(F.col(f"`{name}`").isNull()).limit(1).count():
        raise InvalidArgument(f"field '{name}' is not nullable but would hold nulls")


def _given_null(read: DataFrame, firm: Sequence[str], op: str) -> list:
    """An explicit null for a field that is not nullable; absence is judged elsewhere."""
    if PRESENT in read.columns:
        return [F.when(F.array_contains(PRESENT, c) & F.col(f"`{c}`").isNull(), F.lit(f"field '{c}' must not be null")) for c in firm]
    if op != "update":
        return []
    return [F.when(F.col(f"`{c}`").isNull(), F.lit(f"field '{c}' must not be null")) for c in firm]


def _metric(declared: Field) -> str:
    return (declared.index.metric if declared.index else None) or "l2"


def _result_rows(done: DataFrame, pk: str) -> DataFrame:
    return done.select(F.col(pk).alias("pk"), "op", "code", "message")
