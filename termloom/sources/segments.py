"""A stored index that grows: segments, each a stored index, and a manifest of those in use.

Adding documents writes a segment and a new version of the manifest, nothing else. Documents that
an older segment has are replaced: the new segment lists them, with what they counted for in the
statistics, so reading subtracts that and passes over their entries. `merge` writes the segments
in use as one, bucket by bucket of the units. Readers see one version as a whole: a version is
there when its folder is complete, and no version is ever changed.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.operators.index import UNIT, StoredIndex, TextIndex, unit_bucket
from termloom.operators.joins import fits_broadcast
from termloom.operators.staging import stage
from termloom.sources import sinks

MANIFEST = "version long, segment string, number int"


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions of the manifest, oldest first; none where there is no index yet."""
    store, folder = _files(spark, f"{path}/manifest")
    if not store.exists(folder):
        return []
    done = [s.getPath() for s in store.listStatus(folder) if store.exists(_files(spark, f"{s.getPath()}/_SUCCESS")[1])]
    return sorted(int(p.getName().removeprefix("version=")) for p in done)


def segments(spark: SparkSession, path: str, version: int | None = None) -> list[str]:
    """Names of the segments of a version, oldest first; of the latest one by default."""
    known = versions(spark, path)
    if not known:
        return []
    rows = spark.read.schema("segment string, number int").json(f"{path}/manifest/version={known[-1] if version is None else version}")
    return [r.segment for r in sorted(rows.collect(), key=lambda r: r.number)]  # a row per segment in use


def _publish(spark: SparkSession, path: str, names: Sequence[str]) -> None:
    """The next version; a writer that was overtaken by another one gets an error, not a mixture."""
    version = (versions(spark, path) or [0])[-1] + 1
    rows = spark.createDataFrame(list(zip(names, range(len(names)))), "segment string, number int")
    rows.coalesce(1).write.mode("error").json(f"{path}/manifest/version={version}")


def _sum(column: str, fields: Sequence[str], sign: int = 1):
    return F.struct(*[(sign * F.col(column)[f]).alias(f) for f in fields]).alias(column)


def append(index: TextIndex, path: str) -> str:
    """Add the documents of `index` to the index in `path`, which need not exist; the new segment's name.

    Documents that are there already are replaced. An index without documents adds an empty
    segment. Fields must be those of the stored index, and all segments have the buckets of the
    first one until they are merged.
    """
    spark = index.entries.sparkSession
    names, name = segments(spark, path), uuid.uuid4().hex
    own = f"{path}/segments/{name}"
    before = _read(spark, path, names) if names else None
    sinks.save_index(index, own, buckets=before and before.buckets)
    if names:
        if before.fields != index.fields:
            raise ValueError(f"the stored index has the fields {before.fields}")
        ids = spark.read.parquet(f"{own}/documents").select("doc_id").distinct()
        small = fits_broadcast(ids)
        gone = stage(before.documents.join(F.broadcast(ids) if small else ids, "doc_id", "left_semi"), "replaced")
    else:
        gone = spark.read.parquet(f"{own}/documents").limit(0)
    gone.write.parquet(f"{own}/replaced")
    if names and gone.limit(1).count():
        lost = before.entries.join(F.broadcast(gone.select("doc_id")) if fits_broadcast(gone) else gone.select("doc_id"), "doc_id", "left_semi")
        lost = TextIndex(lost.drop("bucket").unionByName(_own_rows(gone, lost)), index.fields)
        lost.unit_stats.withColumn("bucket", unit_bucket(before.buckets)).write.partitionBy("bucket").parquet(f"{own}/lost_units")
        lost.field_stats.write.parquet(f"{own}/lost_fields")
    _publish(spark, path, [*names, name])
    return name


def _own_rows(documents: DataFrame, like: DataFrame) -> DataFrame:
    """Documents as the entries under the empty unit that stand for them."""
    kept = {"doc_id": "doc_id", "lens": "lens", "kind": "''", "unit": "''"}
    parts = [F.expr(kept.get(f.name, "NULL")).cast(f.dataType).alias(f.name) for f in like.drop("bucket").schema]
    return documents.select(*parts).withColumn("tf", F.struct(*[F.lit(0).cast("long").alias(f) for f in documents.schema["lens"].dataType.names]))


def load(spark: SparkSession, path: str, version: int | None = None) -> StoredIndex:
    """The index of a version, of the latest by default: rows and statistics as of an index built at once."""
    names = segments(spark, path, version)
    if not names:
        raise ValueError(f"no index in {path}")
    return _read(spark, path, names)


def _read(spark: SparkSession, path: str, names: Sequence[str]) -> StoredIndex:
    parts = [sinks.load_index(spark, f"{path}/segments/{n}") for n in names]
    fields = parts[0].fields
    replaced = [spark.read.schema(parts[0].documents.schema).parquet(f"{path}/segments/{n}/replaced").select("doc_id") for n in names]
    # replaced[i] holds what is wrong in the segments before i; small in most steps, and empty without replacements
    later, entries, documents = None, [], []
    for part, ids in zip(reversed(parts), reversed(replaced)):
        entries.append(_without(part.entries, later))
        documents.append(_without(part.documents, later))
        later = ids if later is None else later.union(ids)
    units, totals = [p.unit_stats for p in parts], [p.field_stats for p in parts]
    for n in names:
        if _has(spark, f"{path}/segments/{n}/lost_units"):
            units.append(_negated(spark.read.schema(parts[0].unit_stats.schema).parquet(f"{path}/segments/{n}/lost_units"), fields))
            minus = spark.read.parquet(f"{path}/segments/{n}/lost_fields")
            totals.append(minus.select("field", *[(-F.col(c)).alias(c) for c in ("n_docs", "doc_count", "total_len")]))
    stats = _added(units).groupBy(*UNIT, "bucket").agg(
        *[F.struct(*[F.sum(F.col(c)[f]).alias(f) for f in fields]).alias(c) for c in ("df", "ttf")]
    ).filter(sum([F.col("df")[f] for f in fields[1:]], F.col("df")[fields[0]]) > 0)
    by_field = _added(totals).groupBy("field").agg(*[F.sum(c).alias(c) for c in ("n_docs", "doc_count", "total_len")])
    return StoredIndex(_added(entries), fields, stored_documents=_added(documents), stored_units=stats, stored_fields=by_field, buckets=parts[0].buckets)


def _has(spark: SparkSession, path: str) -> bool:
    store, folder = _files(spark, path)
    return store.exists(folder)


def _added(frames: Sequence[DataFrame]) -> DataFrame:
    found = frames[0]
    for frame in frames[1:]:
        found = found.unionByName(frame)
    return found


def _negated(units: DataFrame, fields: Sequence[str]) -> DataFrame:
    return units.select(*UNIT, _sum("df", fields, -1), _sum("ttf", fields, -1), "bucket")


def _without(rows: DataFrame, ids: DataFrame | None) -> DataFrame:
    if ids is None:
        return rows
    gone = ids.distinct()
    return rows.join(F.broadcast(gone) if fits_broadcast(gone) else gone, "doc_id", "left_anti")


def merge(spark: SparkSession, path: str) -> str:
    """Write the segments in use as one and use that; the folders of the others stay for their readers."""
    whole = load(spark, path)
    own_rows = _own_rows(whole.documents, whole.entries)
    flat = TextIndex(whole.entries.drop("bucket").unionByName(own_rows), whole.fields)
    name = uuid.uuid4().hex
    sinks.save_index(flat, f"{path}/segments/{name}", known=replace(whole, stored_units=stage(whole.unit_stats.drop("bucket"), "unit-stats")))
    spark.read.parquet(f"{path}/segments/{name}/documents").limit(0).write.parquet(f"{path}/segments/{name}/replaced")
    _publish(spark, path, [name])
    return name


def remove_unused(spark: SparkSession, path: str) -> list[str]:
    """Delete the segments that the latest version does not use; for when no reader of older versions is left."""
    used = set(segments(spark, path))
    store, folder = _files(spark, f"{path}/segments")
    unused = [s.getPath() for s in store.listStatus(folder) if s.getPath().getName() not in used]
    for old in unused:
        store.delete(old, True)
    return sorted(p.getName() for p in unused)
