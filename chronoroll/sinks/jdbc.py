"""Relational sink over JDBC (K3)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..spec import JdbcOptions


def jdbc_write_options(opts: JdbcOptions, table: str, mode: str = "overwrite",
                       truncate: bool = True, batch_size: int = 10_000,
                       num_partitions: int | None = None) -> dict[str, str]:
    """``truncate`` keeps the table definition on overwrite; ``num_partitions``
    caps concurrent connections (Spark coalesces to it before writing)."""
    out = opts.as_dict()
    out.update(dbtable=table, batchsize=str(batch_size))
    if mode == "overwrite":
        out["truncate"] = str(truncate).lower()
    if num_partitions:
        out["numPartitions"] = str(num_partitions)
    return out


def write_jdbc(df: DataFrame, opts: JdbcOptions, table: str, mode: str = "overwrite", **kw) -> None:
    (df.write.format("jdbc").mode(mode)
     .options(**jdbc_write_options(opts, table, mode=mode, **kw)).save())
