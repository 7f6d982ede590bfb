"""The supplied tables in the roles of connection records.

Every field of the record is an expression over ``lineitem`` that means the same in Spark SQL and
in standard SQL, so the checking queries start from the same records. The label is a rule over
other fields ("planted"): it lets a model test show that training works, nothing more.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import ExitStack, contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from connlens.fields import FIELD_NAMES, RATE_POSITIONS
from connlens.sources import kept, read_table, spread_by_rows, spread_if_few
from connlens.sources.lines import interaction_lines
from connlens.sources.tables import STORED_BYTES

TABLE = "lineitem"

_TEXT = {
    "protocol_type": "CASE l_linestatus WHEN 'O' THEN 'tcp' ELSE 'udp' END",
    "service": "concat('svc_', CAST(l_linenumber AS STRING))",
    "flag": "CASE l_returnflag WHEN 'A' THEN 'SF' WHEN 'N' THEN 'S0' ELSE 'REJ' END",
    "attack": (
        "CASE WHEN l_tax > 0.06 THEN 'smurf.' "
        "WHEN l_quantity > 30 AND l_linestatus = 'O' THEN 'neptune.' "
        "WHEN l_quantity < 3 THEN 'buffer_overflow.' ELSE 'normal.' END"
    ),
}

_WHOLE = {
    "duration": "l_quantity",
    "src_bytes": "floor(l_extendedprice)",
    "dst_bytes": "CASE WHEN l_discount = 0 THEN 0 ELSE l_partkey END",
    "land": "0",
    "wrong_fragment": "l_suppkey % 3",
    "urgent": "CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END",
    "hot": "l_linenumber % 4",
    "num_failed_logins": "l_partkey % 5",
    "logged_in": "CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END",
    "num_compromised": "l_suppkey % 4",
    "root_shell": "CASE WHEN l_quantity = 50 THEN 1 ELSE 0 END",
    "su_attempted": "l_orderkey % 3",
    "num_root": "l_suppkey % 4 + CASE WHEN l_quantity = 50 THEN 1 ELSE 0 END",
    "num_file_creations": "l_partkey % 7",
    "num_shells": "l_orderkey % 2",
    "num_access_files": "l_partkey % 2",
    "num_outbound_cmds": "0",
    "is_host_login": "CASE WHEN l_orderkey % 97 = 0 THEN 1 ELSE 0 END",
    "is_guest_login": "CASE WHEN l_partkey % 11 = 0 THEN 1 ELSE 0 END",
    "count": "l_orderkey % 512",
    "srv_count": "l_orderkey % 512 + l_linenumber",
    "dst_host_count": "l_suppkey % 256",
    "dst_host_srv_count": "l_partkey % 256",
}

_RATE = {
    "serror_rate": "l_discount",
    "srv_serror_rate": "l_discount",
    "rerror_rate": "l_tax",
    "srv_rerror_rate": "l_tax * 0.5",
    "same_srv_rate": "1 - l_discount",
    "diff_srv_rate": "l_discount * l_tax",
    "srv_diff_host_rate": "CAST(l_partkey % 101 AS DOUBLE) / 100",
    "dst_host_same_srv_rate": "l_quantity / 50",
    "dst_host_diff_srv_rate": "CAST(l_partkey % 100 AS DOUBLE) / 100",
    "dst_host_same_src_port_rate": "CAST(l_suppkey % 100 AS DOUBLE) / 100",
    "dst_host_srv_diff_host_rate": "CAST(l_orderkey % 100 AS DOUBLE) / 100",
    "dst_host_serror_rate": "l_discount * 0.8",
    "dst_host_srv_serror_rate": "l_discount * 0.8 + l_tax * 0.1",
    "dst_host_rerror_rate": "l_tax * 0.9",
    "dst_host_srv_rerror_rate": "l_tax * 0.9 + l_discount * 0.1",
}


def _expression(name: str) -> str:
    if name in _TEXT:
        return _TEXT[name]
    return f"CAST({_WHOLE[name]} AS BIGINT)" if name in _WHOLE else f"CAST({_RATE[name]} AS DOUBLE)"


assert {FIELD_NAMES[p] for p in RATE_POSITIONS} == set(_RATE)

KEY = "row_key"
# lineitem has no unique key; this text tells its rows apart except for full copies.
_KEY = (
    "concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), "
    "CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING), CAST(CAST(l_quantity AS BIGINT) AS STRING))"
)
INTERACTION_SELECT = {**{name: _expression(name) for name in FIELD_NAMES}, KEY: _KEY}
#: What the records are made of.
COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
]


def interactions(
    spark: SparkSession, folder: str, heavy: bool = False, stored: int = STORED_BYTES, task_rows: int | None = None
) -> DataFrame:
    """The typed record of every lineitem row, plus a text key. Unused columns are not read.

    ``heavy`` announces dear work per row, for which a small file is spread over all cores, and one of more than
    ``stored`` bytes a core over more partitions. With ``task_rows`` the rows are counted and no partition has many more.
    """
    rows = read_table(spark, folder, TABLE)
    if task_rows is not None:
        rows = spread_by_rows(rows, task_rows)
    elif heavy:
        rows = spread_if_few(rows, stored)
    return _records(rows)


def _records(rows: DataFrame) -> DataFrame:
    return rows.selectExpr(
        *[f"{expression} AS `{name}`" for name, expression in INTERACTION_SELECT.items()]
    )


@contextmanager
def kept_interactions(
    spark: SparkSession, folder: str, split: Callable[[DataFrame], Iterable[DataFrame]], task_rows: int
) -> Iterator[list[DataFrame]]:
    """The sides into which ``split`` divides the records by their key, for work that passes over them many times, until the block ends.

    Kept on disk are the columns of the table, few beside those of the records; each pass makes the records anew, without the key's hash, and memory
    is left to what training itself keeps. A partition has about ``task_rows`` rows at most. Results must be written or collected inside the block.
    """
    table = read_table(spark, folder, TABLE).select(*COLUMNS)
    total = table.count()
    with ExitStack() as stack:
        yield [
            _records(stack.enter_context(kept(spread_by_rows(side.select(*COLUMNS), task_rows, total), StorageLevel.DISK_ONLY)))
            for side in split(table.selectExpr("*", f"{_KEY} AS `{KEY}`"))
        ]


def in_part(part: int, of: int) -> Column:
    """Is a record in this one of several parts? Told by its key, so that a part is known before its lines are made."""
    return F.pmod(F.xxhash64(KEY), F.lit(of)) == part


def interaction_text(spark: SparkSession, folder: str, where: Column | None = None) -> DataFrame:
    """The same records, or those that meet a condition, as text lines of 42 fields."""
    rows = interactions(spark, folder, heavy=True)
    return interaction_lines(rows if where is None else rows.filter(where))


def over_interactions(sql: str) -> str:
    """Standard SQL in which ``interactions`` is the typed record table."""
    fields = ", ".join(f'{e} AS "{name}"' for name, e in INTERACTION_SELECT.items())
    with_interactions = f"WITH interactions AS (SELECT {fields} FROM {TABLE})"
    if sql.lstrip().upper().startswith("WITH "):
        return f"{with_interactions}, {sql.lstrip()[5:]}"
    return f"{with_interactions} {sql}"


# Rates have four digits after the point at most, so this text form is exact and the same in every engine.
_RATE_TEXT = "DECIMAL(9, 4)"


def raw_lines(
    spark: SparkSession, folder: str, where: Column | None = None, stored: int = STORED_BYTES
) -> DataFrame:
    """The records, or those that meet a condition, as text lines of 42 fields, the rates with four digits after the point."""
    rows = interactions(spark, folder, heavy=True, stored=stored)
    rows = rows if where is None else rows.filter(where)
    return interaction_lines(rows.withColumns({name: F.col(name).cast(_RATE_TEXT) for name in _RATE}))


def raw_text(field: str) -> str:
    """The text of a field of a raw line, in the SQL that checks."""
    return f'CAST(CAST("{field}" AS {_RATE_TEXT}) AS VARCHAR)' if field in _RATE else f'CAST("{field}" AS VARCHAR)'


def raw_line(sep: str = ",", fields: list[str] = FIELD_NAMES) -> str:
    return f"concat_ws('{sep}', {', '.join(map(raw_text, fields))})"


RAW_LINE = raw_line()
