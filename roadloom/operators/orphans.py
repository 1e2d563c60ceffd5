"""References to records that are missing, deleted or arrive later, kept as state that arrivals advance."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadloom.operators.keys import current_rows, is_blank, read_id, read_word
from roadloom.operators.skew import relay_join
from roadloom.storage import Scratch, Tables

PARENT = ["kind", "scope", "key"]
REF = ["ref_table", "ref_id"]
PARENT_SCHEMA = "kind string, scope bigint, key bigint, first_at timestamp_ntz, last_at timestamp_ntz, deleted boolean"
REF_SCHEMA = "ref_table string, ref_id bigint, loaded_at timestamp_ntz, scope bigint, kind string, key bigint"
COUNT_SCHEMA = "ref_table string, reason string, period string, orphans bigint"
#: Buckets of the state. A step reads only those that its keys fall into.
BUCKETS = 16
#: Steps after which a table's changes are folded into one.
COMPACT = 16


def _loaded():
    return F.col("loaded_at").cast("timestamp_ntz")


def _standing(of: Column | None = None, tag: str = "") -> tuple[list[Column], Column]:
    """Aggregates ``first_at`` and ``last_at`` (and helpers) over a record's rows, or over those that ``of`` names, and
    ``deleted`` of the greatest (last_at, deleted), nulls least, from them. Each is a minimum or maximum of a plain
    column, which Spark aggregates by hash; for a maximum of structs it would sort all rows."""
    of = F.lit(True) if of is None else of
    aggs = {"first_at": F.min(F.when(of, F.col("first_at"))), "last_at": F.max(F.when(of, F.col("last_at"))), "any": F.max(F.when(of, F.col("deleted")))}
    aggs |= {k: F.max(F.when(of & on, F.col("last_at"))) for k, on in (("gone", F.col("deleted")), ("here", ~F.col("deleted")))}
    last, every, gone, here = (F.col(tag + k) for k in ("last_at", "any", "gone", "here"))
    return [a.alias(tag + k) for k, a in aggs.items()], F.when(last.isNull(), every).when(gone == last, True).when(here == last, False)


def fold_parents(rows: DataFrame) -> DataFrame:
    """One row per record: its first and last load and whether the current row is deleted. Folding folded rows again
    is allowed: minimum and maximum make the state mergeable in any order, which late files need."""
    aggs, deleted = _standing()
    return rows.groupBy(*PARENT).agg(*aggs).select(*PARENT, "first_at", "last_at", deleted.alias("deleted"))


def reason() -> Column:
    """Why a reference (with its record's ``first_at`` and ``deleted``, null without record) is an orphan, or null."""
    return (
        F.when(F.col("first_at").isNull() & F.col("deleted").isNull(), "missing")
        .when(F.col("deleted"), "deleted")
        .when(F.col("first_at") > F.col("loaded_at"), "late")
    )


def _month(at: str = "loaded_at") -> Column:
    return F.date_format(at, "yyyy-MM")


class ReferenceLedger:
    """Orphan state that follows arrivals.

    Four tables, the first three in ``buckets`` folders by a hash of the key, so that a step reads only the folders that the
    keys of its arrivals fall into:

    * ``parents`` by record: first load, last load, deleted;
    * ``refs`` by reference: its current version, which tells an older version from a newer one;
    * ``uses`` by the record referred to: the references that wait for it or rest on it, with the reason they were last
      judged by. Those with a reason are the pending orphans that an arriving record may resolve, the others those that
      a deletion or an earlier load reopens;
    * ``pending``: the changes of reason, so the orphans themselves.

    ``advance`` takes rows in any order. New references probe the parent index; records that are new or changed judge
    the references in ``uses`` anew; a newer version of a reference withdraws the older one. Each step appends its
    changes, and after ``COMPACT`` steps a table's changes are folded into one. Counts per table, reason and month are
    carried on from step to step (``snapshot``).

    With ``path``, a folder all executors reach, the state lasts: a step counts once its commit file stands, so a ledger
    opened on the folder goes on after the last whole step, and a step of a ``batch`` number that was committed before is
    passed over. Without ``path`` it lives in the session's shared folder until the process ends.

    Rows with a null ``ref_table``/``ref_id`` are kept as references of that null key; a null ``key`` (an id that reads
    as none) can meet no record. Repeated rows change nothing. Empty batches are allowed.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = BUCKETS):
        self.spark, self.buckets = spark, buckets
        self.store = Tables(spark, path or Scratch(spark, "orphans").path("state"))
        state = self.store.committed()
        self.step, self.batch, self.live = state.get("step", 0), state.get("batch"), state.get("live", {})
        self.buckets = state.get("buckets", buckets)

    def _bucket(self, *keys: str) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")

    def _in(self, df: DataFrame) -> set[int]:
        """The buckets that the records named by some rows fall into."""
        return {r[0] for r in df.select(self._bucket(*PARENT)).distinct().collect()}

    def _add(self, df: DataFrame, table: str, keys: Sequence[str], spread: Sequence[str] = (), name: str = "") -> DataFrame:
        """Writes rows of this step by buckets and reads them back. Where one key may have many rows, ``spread`` tells
        them apart, and a bucket is written by several tasks."""
        salt = [F.pmod(F.xxhash64(*spread), F.lit(16))] if spread else []
        name = name or str(self.step)
        self.store.write(df.withColumn("bucket", self._bucket(*keys)).repartition("bucket", *salt), table, name)
        self.live.setdefault(table, []).append(name)
        return self.store.read(df.schema, table, name)

    def _state(self, table: str, schema: str, buckets: set[int] | None = None) -> DataFrame:
        """The changes of a table before this step, with the step of each, from the given buckets only."""
        parts = [self.store.read(schema, table, n, buckets).withColumn("step", F.lit(int(n.rstrip("f")))) for n in self.live.get(table, []) if n != str(self.step)]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], f"{schema}, step int")

    def advance(self, new_parents: DataFrame, new_refs: DataFrame, batch: int | None = None) -> None:
        """One step: the rows of records and references that arrived since the last one."""
        if batch is not None and self.batch is not None and batch <= self.batch:
            return
        first, self.step = not self.live, self.step + 1
        parents = new_parents.select(*_names(PARENT_SCHEMA))
        refs = current_rows(new_refs.select(*_names(REF_SCHEMA)), REF)
        own = set() if first else self._in(new_parents)
        which = set() if first else {r[0] for r in new_refs.select(self._bucket(*REF)).distinct().collect()}
        uses = self._begin(parents, refs) if first else self._follow(parents, refs, own, which)
        # what each reference was and is now; a replaced version and its successor are one change. A row that neither was
        # nor is an orphan adds nothing to it
        uses = uses.where("was is not null or live and reason is not null")
        one = F.max(F.struct("live", *_names(REF_SCHEMA)[2:], F.when(F.col("live"), F.col("reason")).alias("reason"))).alias("_b")
        change = uses.withColumn("was_month", F.when(F.col("was").isNotNull(), _month())).groupBy(*REF).agg(one, F.max("was").alias("was"), F.max("was_month").alias("was_month"), F.count("*").alias("_n"))
        change = change.select(*REF, *[F.col(f"_b.{c}").alias(c) for c in (*_names(REF_SCHEMA)[2:], "reason")], "was", "was_month", "_n")
        change = change.where("(reason is not null or was is not null) and not (_n = 1 and was <=> reason)").drop("_n")
        self.store.save(change, "pending", str(self.step))
        self.live.setdefault("pending", []).append(str(self.step))
        moved = self.store.read(change.schema, "pending", str(self.step))
        plus = moved.where("reason is not null").select("ref_table", "reason", _month().alias("period"), F.lit(1).cast("bigint").alias("orphans"))
        minus = moved.where("was is not null").select("ref_table", F.col("was").alias("reason"), F.col("was_month").alias("period"), F.lit(-1).cast("bigint").alias("orphans"))
        counts = self.snapshot(self.step - 1).unionByName(plus).unionByName(minus).groupBy("ref_table", "reason", "period").agg(F.sum("orphans").alias("orphans"))
        self.store.save(counts.where("orphans <> 0").coalesce(1), "counts", str(self.step))
        stale = self._compact()
        self.batch = self.batch if batch is None else batch
        self.store.commit(self.step, {"step": self.step, "batch": self.batch, "buckets": self.buckets, "live": self.live})
        for table, name in stale:
            self.store.drop(table, name)

    def _begin(self, parents: DataFrame, refs: DataFrame) -> DataFrame:
        """The first step: nothing is known, so all references probe all records."""
        known = self._add(fold_parents(parents), "parents", PARENT)
        won = self._add(refs, "refs", REF).where("kind is not null")
        judged = relay_join(won, known.select(*PARENT, "first_at", "deleted"), PARENT, F.col("ref_id"))
        return self._add(judged.select(*_names(REF_SCHEMA), reason().alias("reason"), F.lit(None).cast("string").alias("was"), F.lit(True).alias("live")), "uses", PARENT, REF)

    def _follow(self, parents: DataFrame, refs: DataFrame, own: set[int], which: set[int]) -> DataFrame:
        """A later step: reads of the state only the buckets that its keys fall into (``own`` by record, ``which`` by
        reference)."""
        # records: what arrived, merged with what is known of the same keys, and whether they stand differently now; one
        # pass over both
        every = parents.withColumn("_new", F.lit(True)).unionByName(self._state("parents", PARENT_SCHEMA, own).drop("step").withColumn("_new", F.lit(False)))
        (now, deleted), (before, was_deleted) = _standing(), _standing(~F.col("_new"), "was_")
        merged = every.groupBy(*PARENT).agg(*now, *before, F.max("_new").alias("_came"), F.min("_new").alias("_first")).where("_came").withColumn("deleted", deleted)
        changed = F.col("_first") | ~F.struct("first_at", "deleted").eqNullSafe(F.struct(F.col("was_first_at").alias("first_at"), was_deleted.alias("deleted")))
        stands = self._add(merged.select(*_names(PARENT_SCHEMA), changed.alias("changed")), "parents", PARENT)
        # references: the versions that are newer than the one known, each with the one it replaces
        had = self._state("refs", REF_SCHEMA, which).drop("step")
        had = current_rows(had, REF) if self._parts("refs") > 1 else had
        version = lambda t: F.struct(*[F.col(f"{t}.{c}") for c in _names(REF_SCHEMA)[2:]])
        meet = refs.alias("a").join(had.withColumn("there", F.lit(True)).alias("h"), _same("a", "h", REF), "left").where(F.col("h.there").isNull() | (version("a") > version("h")))
        old = F.when(F.col("h.there"), F.struct(*[F.col(f"h.{c}").alias(c) for c in _names(REF_SCHEMA)]))
        won = self._add(meet.select(*[F.col(f"a.{c}").alias(c) for c in _names(REF_SCHEMA)], old.alias("old")), "refs", REF)
        # uses: the references that rest on changed records or wait for them, and the versions that are replaced
        gone = won.where("old is not null").select("old.*").where("kind is not null")
        leave = self._in(gone)
        latest = self._state("uses", _USES, own | leave)
        latest = (self._latest(latest, [*REF, "loaded_at", *PARENT]) if self._parts("uses") > 1 else latest.drop("step")).where("live")
        rest = relay_join(latest, stands.where("changed").select(*PARENT, "first_at", "deleted", F.lit(True).alias("_hit")), PARENT, F.col("ref_id"))
        # those that a changed record hits are judged by it, those that only leave need no reason
        rest = rest.withColumnRenamed("reason", "was").withColumn("reason", F.when(F.col("_hit"), reason()))
        rest = rest.alias("u").join(gone.select(*REF, "loaded_at", F.lit(True).alias("_gone")).alias("g"), _same("u", "g", [*REF, "loaded_at"]), "left")
        rest = rest.where("_hit or _gone").select(*[F.col(f"u.{c}").alias(c) for c in (*_names(REF_SCHEMA), "reason", "was")], F.col("_gone").isNull().alias("live"))
        # probing: the records that new versions refer to, as they stand now
        fresh = won.where("kind is not null").select(*_names(REF_SCHEMA))
        probe = self._in(fresh)
        known = fold_parents(self._state("parents", PARENT_SCHEMA, probe).drop("step").unionByName(self.store.read(PARENT_SCHEMA, "parents", str(self.step), probe)))
        judged = relay_join(fresh, known.select(*PARENT, "first_at", "deleted"), PARENT, F.col("ref_id"))
        judged = judged.select(*_names(REF_SCHEMA), reason().alias("reason"), F.lit(None).cast("string").alias("was"), F.lit(True).alias("live"))
        return self._add(judged.unionByName(rest), "uses", PARENT, REF)

    def _parts(self, table: str) -> int:
        """How many parts hold the changes of a table before this step. In each part a key occurs once."""
        return sum(n != str(self.step) for n in self.live.get(table, []))

    def _latest(self, df: DataFrame, keys: list[str]) -> DataFrame:
        """Of the changes of each key the last."""
        rest = [c for c in df.columns if c not in keys and c != "step"]
        best = F.max(F.struct("step", *rest)).alias("_b")
        return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_b.{c}").alias(c) for c in rest])

    def _compact(self) -> list[tuple[str, str]]:
        """Folds tables that have gathered many changes into one; returns the folders that are no longer needed."""
        stale = []
        for table, schema, keys in (("parents", PARENT_SCHEMA, PARENT), ("refs", REF_SCHEMA, REF), ("uses", _USES, PARENT), ("pending", _PENDING, REF)):
            names = self.live[table]
            if len(names) < COMPACT:
                continue
            every = reduce(DataFrame.unionByName, [self.store.read(schema, table, n).withColumn("step", F.lit(int(n.rstrip("f")))) for n in names])
            if table == "parents":
                folded = fold_parents(every.drop("step"))
            elif table == "refs":
                folded = current_rows(every.drop("step"), REF)
            elif table == "uses":
                folded = self._latest(every, [*REF, "loaded_at", *PARENT]).where("live").select(*_names(_USES))
            else:
                folded = self._latest(every, REF).where("reason is not null").select(*_names(_PENDING))
            self.live[table] = []
            if table == "pending":
                self.store.save(folded, table, f"{self.step}f")
                self.live[table] = [f"{self.step}f"]
            else:
                self._add(folded, table, keys, REF if table == "uses" else (), name=f"{self.step}f")
            stale += [(table, n) for n in names]
        return stale

    def cases(self) -> DataFrame:
        """The orphans after the last step: the reference's columns and the reason. To be read before the next step, as
        that may fold the tables."""
        parts = [self.store.read(_PENDING, "pending", n).withColumn("step", F.lit(int(n.rstrip("f")))) for n in self.live.get("pending", [])]
        every = reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], f"{_PENDING}, step int")
        return self._latest(every, REF).where("reason is not null").select(*_names(_PENDING))

    def snapshot(self, step: int | None = None) -> DataFrame:
        """Counts per table, reason and month after the last step, or an earlier one."""
        step = self.step if step is None else step
        return self.store.read(COUNT_SCHEMA, "counts", str(step)) if step else self.spark.createDataFrame([], COUNT_SCHEMA)

    def snapshots(self) -> DataFrame:
        """The counts after every step, with its number."""
        every = [self.snapshot(s).withColumn("step", F.lit(s)) for s in range(1, self.step + 1)]
        return reduce(DataFrame.unionByName, every) if every else self.spark.createDataFrame([], f"{COUNT_SCHEMA}, step int")


_USES = f"{REF_SCHEMA}, reason string, live boolean"
_PENDING = f"{REF_SCHEMA}, reason string"


def _same(a: str, b: str, cols: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cols])


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def map_parents(tables: dict[str, DataFrame]) -> DataFrame:
    """All rows of the five record tables as (kind, scope, key, first_at, last_at, deleted)."""

    def of(table: str, kind: str, key) -> DataFrame:
        df = tables[table]
        gone = F.col("deleted_at").isNotNull() if "deleted_at" in df.columns else F.lit(False)
        return df.select(F.lit(kind).alias("kind"), F.col("map_id").alias("scope"), key.cast("bigint").alias("key"), _loaded().alias("first_at"), _loaded().alias("last_at"), gone.alias("deleted"))

    every = of("osm_node", "node", F.col("node_id"))
    every = every.unionByName(of("osm_way", "way", F.col("way_id"))).unionByName(of("osm_relation", "relation", F.col("rel_id")))
    every = every.unionByName(of("road", "road", read_id(F.col("road_id")))).unionByName(of("junction", "junction", read_id(F.col("junction_id"))))
    return every.where(F.col("scope").isNotNull() & F.col("key").isNotNull())


def map_references(tables: dict[str, DataFrame]) -> DataFrame:
    """All rows of the three reference tables. ``kind`` is null where the row holds no reference (blank id or type), so
    that such a row can still supersede an older version that held one."""

    def of(table: str, ref_id: str, ref: str, kind) -> DataFrame:
        text = F.col(ref)
        return tables[table].select(F.lit(table).alias("ref_table"), F.col(ref_id).alias("ref_id"), _loaded().alias("loaded_at"), F.col("map_id").alias("scope"), F.when(~is_blank(text), kind).alias("kind"), read_id(text).alias("key"))

    every = of("osm_member", "member_id", "ref", read_word(F.col("mtype")))
    every = every.unionByName(of("junction_connection", "connection_id", "connecting_road", F.lit("road")))
    return every.unionByName(of("road_link", "link_id", "element_id", read_word(F.col("element_type"))))


def orphan_cases(spark: SparkSession, tables: dict[str, DataFrame], steps: int = 2) -> DataFrame:
    """(ref_table, ref_id, reason, period) of all orphans, by feeding the ledger the tables in ``steps`` load-time
    slices of equal width, as a scheduled run would. The number of steps does not change the result.

    A type that names no record table leads nowhere and is missing; period is null where the load time is.
    """
    ledger = ReferenceLedger(spark)
    parents, refs = map_parents(tables), map_references(tables)
    first, last = refs.agg(F.min("loaded_at"), F.max("loaded_at")).first()
    cuts = [F.lit(str(first + (last - first) * i / steps)).cast("timestamp_ntz") for i in range(1, steps)] if first else []
    for i in range(len(cuts) + 1):

        def part(df: DataFrame, col: str, i: int = i) -> DataFrame:
            """The rows of slice i; the first also takes rows without a load time."""
            if i:
                df = df.where(F.col(col) >= cuts[i - 1])
            if i < len(cuts):
                df = df.where((F.col(col) < cuts[i]) | F.col(col).isNull()) if not i else df.where(F.col(col) < cuts[i])
            return df

        ledger.advance(part(parents, "first_at"), part(refs, "loaded_at"))
    return ledger.cases().select("ref_table", "ref_id", "reason", F.date_format("loaded_at", "yyyy-MM").alias("period"))
