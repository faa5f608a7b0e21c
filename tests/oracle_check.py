"""Compare a Spark result with DuckDB: names, type families, rows as a multiset."""

from __future__ import annotations

import collections
import datetime as dt
import decimal

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _family(type_text: str) -> str:
    t = type_text.lower()
    for family, starts in {
        "int": ("int", "bigint", "long", "smallint", "integer", "tinyint"),
        "float": ("double", "float"),
        "decimal": ("decimal",),
        "text": ("string", "varchar"),
        "date": ("date",),
        "bool": ("boolean",),
        "time": ("timestamp",),
    }.items():
        if family != "date" and t.startswith(starts) and not t.endswith("[]"):
            return family
        if family == "date" and t == "date":
            return family
    return t


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return ("d", value.normalize())
    if isinstance(value, float):
        return ("f", repr(value))
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def compare(spark_df, con, sql: str) -> list[str]:
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    types = {c[0]: _family(str(c[1])) for c in cursor.description}
    expected = cursor.fetchall()
    problems = []
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns differ: spark {sorted(spark_df.columns)} sql {sorted(names)}"]
    for field in spark_df.schema.fields:
        family = _family(field.dataType.simpleString())
        if family != types[field.name]:
            problems.append(f"type of {field.name}: spark {field.dataType.simpleString()} sql {types[field.name]}")
    order = sorted(names)
    got = [tuple(_plain(r[n]) for n in order) for r in spark_df.collect()]
    index = [names.index(n) for n in order]
    want = [tuple(_plain(r[i]) for i in index) for r in expected]
    extra = collections.Counter(got) - collections.Counter(want)
    lacking = collections.Counter(want) - collections.Counter(got)
    if extra or lacking:
        problems.append(f"rows: spark {len(got)} sql {len(want)}, only spark {sum(extra.values())}, only sql {sum(lacking.values())}")
        problems.append(f"order {order}")
        problems += [f"  spark {r}" for r in list(extra)[:2]] + [f"  sql   {r}" for r in list(lacking)[:2]]
    if not got:
        problems.append("EMPTY")
    return problems
