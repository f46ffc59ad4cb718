"""Facts LEFT JOIN the client dimension (JN1-JN3).

The join carries no hint and building its plan runs no job: Spark broadcasts
the dimension when its size, as known from the files or as measured by AQE at run time,
is under ``spark.sql.autoBroadcastJoinThreshold``. Otherwise it is a shuffle join
whose skewed partitions (one client holding a large share of facts) AQE splits;
``salt_buckets`` salts it explicitly instead.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtrail import schemas as S
from adtrail.functions.parsing import to_key, to_timestamp_ntz
from adtrail.operators.cleaning import is_blank
from adtrail.operators.facts import combine_facts

log = logging.getLogger(__name__)

SALT = "_salt"


def salted_left_join(left: DataFrame, right: DataFrame, on: list, buckets: int) -> DataFrame:
    """LEFT JOIN that spreads every key over ``buckets`` tasks.

    Each left row gets a salt from a hash of its whole content -- fixed for
    the row, so a recomputed task sends it to the same bucket -- and each
    right row is replicated once per bucket. A key holding a third of all
    left rows is then split ``buckets`` ways. ``on`` is a list of column
    names, or a function ``(left, right) -> list[Column]`` of conditions.
    """
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(buckets))
    lsalted = left.withColumn(SALT, salt.cast("int"))
    rsalted = right.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    if callable(on):
        cond = on(lsalted, rsalted) + [lsalted[SALT] == rsalted[SALT]]
        return lsalted.join(rsalted, on=cond, how="left").drop(lsalted[SALT]).drop(rsalted[SALT])
    return lsalted.join(rsalted, on=list(on) + [SALT], how="left").drop(SALT)


def client_dimension(clients: DataFrame) -> DataFrame:
    """The five dimension columns, key as text, date as timestamp_ntz."""
    types = {f.name: f.dataType for f in clients.schema.fields}
    cols = []
    for f in S.CLIENT_SCHEMA.fields:
        if f.name not in types:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif f.name == "client_id":
            cols.append(to_key(f.name).alias(f.name))
        elif f.name == "signup_date":
            cols.append(to_timestamp_ntz(f.name, types[f.name]).alias(f.name))
        else:
            cols.append(F.col(f.name).cast("string").alias(f.name))
    return clients.select(*cols)


def join_with_clients(facts: DataFrame, clients: DataFrame, salt_buckets: int = 0) -> DataFrame:
    """LEFT JOIN on ``client_id`` (as text). Duplicate client ids fan out,
    as in any equi-join. Unmatched rows get 'Unknown' text attributes; their
    ``signup_date`` stays NULL (a date column holds no text).

    ``salt_buckets > 1`` spreads every client over that many tasks (see
    ``salted_left_join``); otherwise AQE's skew-join splitting handles hot clients.
    """
    dim = client_dimension(clients)
    left = facts
    if not isinstance(facts.schema["client_id"].dataType, T.StringType):
        left = facts.withColumn("client_id", to_key("client_id"))
    if salt_buckets > 1:
        joined = salted_left_join(left, dim, ["client_id"], salt_buckets)
    else:
        joined = left.join(dim, on="client_id", how="left")
    cols = [F.col(c) for c in left.columns]
    for name in S.CLIENT_ATTRIBUTE_COLUMNS:
        c = F.col(name)
        if name != "signup_date":
            c = F.coalesce(c, F.lit(S.UNKNOWN))
        cols.append(c.alias(name))
    return joined.select(*cols)


def join_marketing_data(cleaned: dict[str, DataFrame], salt_buckets: int = 0,
                        check_empty: bool = True) -> DataFrame | None:
    """No clients (missing, invalid or empty) -> None; otherwise the stacked
    facts joined with the dimension. With no fact rows the result is an
    empty frame with all joined columns (JN3).

    ``check_empty`` looks for one row of the dimension; a caller that has
    passed the gate of essential sources needs no such job.
    """
    clients = cleaned.get(S.CLIENTS)
    if clients is None or is_blank(clients) or (check_empty and clients.isEmpty()):
        log.error("clients are missing or empty; cannot join")
        return None
    return join_with_clients(combine_facts(cleaned, clients.sparkSession), clients, salt_buckets)
