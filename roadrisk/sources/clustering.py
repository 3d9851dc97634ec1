"""Space-filling-curve clustering of incident tables.

Rows are written in the order of a Morton key: the bits of the quantised longitude and
latitude by turns. Rows near each other in the plane then lie in few files and row groups,
whose smallest and largest coordinates let the reader skip the others. A box filter needs
no knowledge of the key: it is an ordinary filter on latitude and longitude.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadrisk.sources.tables import TableStore

BITS = 24  # per coordinate: cells of about two metres
#: Masks that leave room for the other coordinate's bits, from 16-bit groups down to single bits.
SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))


def _spread(c: F.Column) -> F.Column:
    """The bits of a 32-bit number at the even places of a 64-bit one."""
    for shift, mask in SPREAD:
        c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask))
    return c


def _cells(degrees: F.Column, half_range: float) -> F.Column:
    top = 2 ** BITS
    cell = F.floor((degrees + F.lit(half_range)) * F.lit(top / (2 * half_range)))
    return F.greatest(F.lit(0).cast("bigint"), F.least(F.lit(top - 1).cast("bigint"), cell))


def morton_key(lon: F.Column, lat: F.Column) -> F.Column:
    """Morton key of a place, NULL without coordinates."""
    return F.when(lon.isNotNull() & lat.isNotNull(),
                  _spread(_cells(lon, 180.0)).bitwiseOR(F.shiftleft(_spread(_cells(lat, 90.0)), 1)))


def write_clustered(store: TableStore, df: DataFrame, name: str, files: int | None = None,
                    row_group_bytes: int = 64 * 2 ** 20, lon: str = "longitude", lat: str = "latitude") -> str:
    """Overwrite a table in Morton order. Rows are dealt out by ranges of the key; a hash of the
    row breaks ties, so a place with very many rows is split over files as well."""
    files = files or int(store.spark.conf.get("spark.sql.shuffle.partitions"))
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    keyed = df.withColumn("_key", morton_key(F.col(lon), F.col(lat))).withColumn("_tie", F.xxhash64(*plain))
    ordered = keyed.repartitionByRange(files, "_key", "_tie").sortWithinPartitions("_key").drop("_key", "_tie")
    w = ordered.write.format(store.fmt).mode("overwrite").option("parquet.block.size", row_group_bytes)
    if store.database is not None:
        w.saveAsTable(store.table(name))
        return store.table(name)
    w.save(store.path(name))
    return store.path(name)
