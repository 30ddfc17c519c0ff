"""Domain tables. In production they are Parquet, JDBC or catalog tables, named by the setting ``spark.inuring.tables`` or given as
a reader; without either they derive from the test tables by SQL text that Spark and the oracle both run, so a query and its
oracle see the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

RAW = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

PERILS = ("eq", "ws", "cs", "wt", "fl", "wf")
LOADS = ("peril", "growth", "lae", "social", "cedent")
#: Hundredths by which a load of a peril differs from analysis to analysis.
_LOAD_COLUMNS = ", ".join(f"CAST(((o_orderkey + {7 * k}) % {5 + k % 4}) / 100.0 AS DOUBLE) AS {load}_{peril}" for k, (load, peril) in enumerate((x, y) for x in LOADS for y in PERILS))

FIXTURES = {
    "layer": """
        SELECT CAST(p_partkey AS INT) AS layer_id, CAST(p_partkey % 97 AS INT) AS submission_id,
               CAST((p_size % 5) / 4.0 AS DOUBLE) AS placement, p_retailprice AS occ_limit, 2 * p_retailprice AS agg_limit,
               3 * p_retailprice AS risk_limit, CAST(p_size AS DOUBLE) AS occ_retention, CAST(2 * p_size AS DOUBLE) AS agg_retention,
               CAST(3 * p_size AS DOUBLE) AS risk_retention, CAST(p_size * 1000 AS DOUBLE) AS premium,
               DATE '1995-01-01' + CAST((p_partkey * 37) % 2000 AS INT) AS inception,
               DATE '1995-01-01' + CAST((p_partkey * 37) % 2000 + 364 AS INT) AS expiration,
               CAST(p_size % 8 AS INT) AS limit_basis, CAST(CASE p_size % 3 WHEN 0 THEN 10 WHEN 1 THEN 22 ELSE 36 END AS INT) AS status,
               CAST(0.5 AS DOUBLE) AS estimated_share, CAST((p_partkey % 4) / 10.0 AS DOUBLE) AS signed_share,
               CAST(p_partkey * 10 AS BIGINT) AS row_version,
               CASE p_partkey % 6 WHEN 0 THEN 'CA' WHEN 1 THEN 'MA' WHEN 2 THEN 'MI' WHEN 3 THEN 'OP' WHEN 4 THEN 'OT' ELSE 'PC' END AS segment,
               CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE CAST(p_partkey % 3 AS INT) END AS top_up_zone_id,
               CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE DATE '1996-01-01' + CAST(p_partkey % 300 AS INT) END AS bound_fx_date,
               CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE CAST((50 + p_partkey % 100) / 100.0 AS DOUBLE) END AS bound_fx_rate,
               p_partkey % 11 <> 0 AS is_active, p_partkey % 13 = 0 AS is_deleted,
               CASE p_partkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE CONCAT('MK', CAST(p_partkey AS VARCHAR(20))) END AS regis_mkey
        FROM {part}""",
    "reinstatement": """
        SELECT CAST(p_partkey * 2 + n_nationkey AS INT) AS reinstatement_id, CAST(p_partkey AS INT) AS layer_id,
               CAST(n_nationkey + 1 AS INT) AS reinstatement_order, CAST(p_size % 3 AS DOUBLE) AS quantity,
               CAST((n_nationkey + 1) / 2.0 AS DOUBLE) AS premium_share, CAST((1 + p_partkey % 2) / 10.0 AS DOUBLE) AS brokerage_percentage, CAST(p_partkey AS BIGINT) AS row_version
        FROM {part} INNER JOIN {nation} ON n_nationkey < 2 AND p_partkey % 2 <= n_nationkey""",
    "submission": """
        SELECT CAST(s_suppkey AS INT) AS submission_id, CASE s_suppkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' ELSE 'JPY' END AS base_currency,
               CASE s_suppkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'CAD' END AS currency, CAST((80 + s_suppkey % 40) / 100.0 AS DOUBLE) AS fx_rate,
               DATE '1996-06-01' + CAST(s_suppkey % 200 AS INT) AS fx_date, CAST(s_suppkey % 3 AS INT) AS tran_type,
               s_suppkey % 2 = 0 AS is_multiyear, s_suppkey % 5 = 0 AS is_cancellable
        FROM {supplier} WHERE s_suppkey < 97""",
    "retro_program": """
        SELECT CAST(s_suppkey AS INT) AS retro_program_id, CAST(s_nationkey AS INT) AS retro_profile_id,
               DATE '1995-01-01' + CAST((s_suppkey * 97) % 1500 AS INT) AS inception, DATE '1995-01-01' + CAST((s_suppkey * 97) % 1500 + 729 AS INT) AS expiration,
               CAST(s_suppkey % 2 + 1 AS INT) AS retro_program_type, CAST(s_suppkey % 3 AS INT) AS stored_level, CAST(s_suppkey * 90 AS BIGINT) AS row_version
        FROM {supplier}""",
    "retro_profile": "SELECT CAST(n_nationkey AS INT) AS retro_profile_id, n_name AS name FROM {nation}",
    "sp_insurer": "SELECT CAST(s_suppkey + 100000 AS INT) AS sp_insurer_id, CAST(s_suppkey AS INT) AS retro_program_id, CAST(s_suppkey * 30 AS BIGINT) AS row_version FROM {supplier}",
    "retro_investor": """
        SELECT CAST(s_suppkey * 2 + r_regionkey AS INT) AS retro_investor_id, CAST(s_suppkey + 100000 AS INT) AS sp_insurer_id,
               CASE WHEN s_suppkey % 7 = 0 THEN 0.0 ELSE CAST(1000 + s_suppkey AS DOUBLE) END AS target_collateral,
               CAST(100 * (r_regionkey + 1) + s_suppkey AS DOUBLE) AS investment_signed_amt, CAST((r_regionkey + 1) / 10.0 AS DOUBLE) AS investment_signed,
               CAST(s_suppkey * 50 + r_regionkey AS BIGINT) AS row_version
        FROM {supplier} INNER JOIN {region} ON r_regionkey < 2""",
    "retro_program_reset": """
        SELECT CAST(s_suppkey * 2 + r_regionkey AS INT) AS retro_program_reset_id, CAST(s_suppkey AS INT) AS retro_program_id,
               DATE '1995-01-01' + CAST((s_suppkey * 97) % 1500 + 365 * r_regionkey AS INT) AS start_date, CAST(s_suppkey * 20 + r_regionkey AS BIGINT) AS row_version
        FROM {supplier} INNER JOIN {region} ON r_regionkey < 2 AND s_suppkey % 3 = 0""",
    "retro_investor_reset": """
        SELECT CAST(s_suppkey * 4 + r_regionkey AS INT) AS retro_investor_reset_id, CAST(s_suppkey * 2 + r_regionkey % 2 AS INT) AS retro_investor_id,
               CAST(s_suppkey * 2 + FLOOR(r_regionkey / 2.0) AS INT) AS retro_program_reset_id, CAST(2000 + s_suppkey AS DOUBLE) AS target_collateral,
               CAST(150 * (r_regionkey + 1) AS DOUBLE) AS investment_signed_amt, CAST((r_regionkey + 1) / 20.0 AS DOUBLE) AS investment_signed,
               CAST(s_suppkey * 80 + r_regionkey AS BIGINT) AS row_version
        FROM {supplier} INNER JOIN {region} ON r_regionkey < 4 AND s_suppkey % 3 = 0""",
    "retro_zone": """
        SELECT CAST(s_suppkey AS INT) AS retro_program_id, CAST(r_regionkey AS INT) AS top_up_zone_id, CAST((5 + r_regionkey) / 10.0 AS DOUBLE) AS cession, CAST(s_suppkey * 70 + r_regionkey AS BIGINT) AS row_version
        FROM {supplier} INNER JOIN {region} ON r_regionkey < 3 AND s_suppkey % 4 = 0""",
    "retro_allocation": """
        SELECT CAST(l_partkey AS INT) AS layer_id, CAST(l_suppkey * 2 + l_linenumber % 2 AS INT) AS retro_investor_id,
               CAST(MAX(l_discount) * 0.25 AS DOUBLE) AS cession_gross, CAST(MAX(l_orderkey) AS BIGINT) AS row_version
        FROM {lineitem} WHERE l_discount > 0 GROUP BY l_partkey, l_suppkey, l_linenumber % 2""",
    "portfolio": """
        SELECT CAST(r_regionkey AS INT) AS portfolio_id, CAST(r_regionkey AS INT) AS portfolio_type, DATE '1997-03-31' + CAST(100 * r_regionkey AS INT) AS as_of_date
        FROM {region}""",
    "port_layer": """
        SELECT CAST(p_partkey * 10 + r_regionkey AS INT) AS port_layer_id, CAST(p_partkey AS INT) AS layer_id, CAST(r_regionkey AS INT) AS portfolio_id
        FROM {part} INNER JOIN {region} ON p_partkey % 5 = r_regionkey""",
    "port_layer_cession": """
        SELECT CAST(MIN(l_orderkey) * 8 + MIN(l_linenumber) AS BIGINT) AS port_layer_cession_id, CAST(l_partkey * 10 + l_partkey % 5 AS INT) AS port_layer_id,
               CAST(l_suppkey AS INT) AS retro_program_id, CAST(MAX(l_discount) * 0.5 AS DOUBLE) AS cession_gross, MIN(l_linenumber) < 7 AS should_cession_apply, CAST(MAX(l_orderkey) AS BIGINT) AS row_version
        FROM {lineitem} GROUP BY l_partkey, l_suppkey""",
    "fx_rate": """
        SELECT CAST(o_orderdate AS DATE) AS fx_date, 'USD' AS base_currency,
               CASE r_regionkey WHEN 0 THEN 'EUR' WHEN 1 THEN 'GBP' WHEN 2 THEN 'JPY' WHEN 3 THEN 'CAD' ELSE 'USD' END AS currency,
               CASE WHEN r_regionkey = 4 THEN CAST(1.0 AS DOUBLE) ELSE CAST((MAX(o_orderkey) * (r_regionkey + 1) % 100 + 50) / 100.0 AS DOUBLE) END AS rate, CAST(MAX(o_orderkey) AS BIGINT) AS row_version
        FROM {orders} INNER JOIN {region} ON r_regionkey < 5 GROUP BY CAST(o_orderdate AS DATE), r_regionkey""",
    "layer_loss_analysis": """
        SELECT CAST(o_orderkey AS INT) AS loss_analysis_id, CAST(o_custkey AS INT) AS layer_id,
               CAST(CASE SUBSTRING(o_orderpriority, 1, 1) WHEN '1' THEN 1 WHEN '2' THEN 10 WHEN '3' THEN 3 WHEN '4' THEN 30 ELSE 2 END AS INT) AS loss_view,
               CAST(o_orderkey AS BIGINT) AS row_version, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderkey % 100 AS INT) END AS gu_analysis_id,
               CAST(o_orderkey % 100 AS INT) AS own_gu_analysis_id, """
    + _LOAD_COLUMNS
    + """, CAST(0.02 AS DOUBLE) AS inflation
        FROM {orders}""",
    "submission_gu_analysis": "SELECT CAST(s_suppkey AS INT) AS gu_analysis_id, CAST(s_suppkey % 97 AS INT) AS submission_id, CAST((90 + s_suppkey % 20) / 100.0 AS DOUBLE) AS fx_rate FROM {supplier} WHERE s_suppkey % 2 = 0",
    "px_section": """
        SELECT CAST(a.p_partkey AS INT) AS layer_id, CAST(a.p_partkey + 1 AS INT) AS px_layer_id, CAST(a.p_size % 3 AS INT) AS rollup
        FROM {part} a INNER JOIN {part} b ON b.p_partkey = a.p_partkey + 1 WHERE a.p_partkey % 5 < 3""",
    "layer_yelt": """
        SELECT CAST(l_partkey AS INT) AS layer_id, CAST(l_orderkey % 10000 + 1 AS INT) AS year, CAST(l_orderkey % 365 + 1 AS INT) AS day,
               CAST(CASE l_orderkey % 3 WHEN 0 THEN 3 WHEN 1 THEN 16 ELSE 1 END AS INT) AS peril_id, CAST(l_orderkey + 1 AS BIGINT) AS event_id,
               CAST(SUM(CAST(l_discount AS DECIMAL(18,4))) AS DOUBLE) AS loss_pct, CAST(SUM(CAST(l_tax AS DECIMAL(18,4))) AS DOUBLE) AS rp,
               CAST(MIN(l_linenumber) % 4 + 1 AS INT) AS loss_type
        FROM {lineitem} GROUP BY l_partkey, l_orderkey""",
    "layer_analysis_yelt": """
        SELECT CAST(o_orderkey AS INT) AS loss_analysis_id, CAST(o_orderkey AS BIGINT) AS row_version, CAST(l_partkey AS INT) AS layer_id,
               CAST(l_orderkey % 10000 + 1 AS INT) AS year, CAST(l_orderkey % 365 + 1 AS INT) AS day,
               CAST(CASE l_orderkey % 4 WHEN 0 THEN 3 WHEN 1 THEN 16 WHEN 2 THEN 1 ELSE 14 END AS INT) AS peril_id, CAST(l_orderkey + 1 AS BIGINT) AS event_id,
               CAST(SUM(CAST(l_discount AS DECIMAL(18,4))) AS DOUBLE) AS loss_pct, CAST(SUM(CAST(l_tax AS DECIMAL(18,4))) AS DOUBLE) AS rp,
               CAST(MIN(l_linenumber) % 4 + 1 AS INT) AS loss_type
        FROM {lineitem} INNER JOIN {orders} ON o_custkey = l_partkey AND o_orderkey % 5 = l_orderkey % 5 GROUP BY o_orderkey, l_partkey, l_orderkey""",
    "gu_yelt_entry": """
        SELECT CAST(l_suppkey AS INT) AS gu_analysis_id, CAST(l_orderkey % 1000 + 1 AS INT) AS year, CAST(l_orderkey % 365 + 1 AS INT) AS day,
               CAST(CASE l_orderkey % 3 WHEN 0 THEN 3 WHEN 1 THEN 16 ELSE 1 END AS INT) AS peril_id, CAST(l_orderkey % 500 AS BIGINT) AS event_id,
               CAST(l_quantity AS DECIMAL(18,4)) AS loss
        FROM {lineitem}""",
    "scenario": """
        SELECT CAST(event_id % 50 AS BIGINT) AS scenario_id, CAST(MIN(ts) AS DATE) AS run_date, CAST(event_id % 50 AS INT) % 9 <> 0 AS is_active, CAST(event_id % 50 AS INT) % 10 = 0 AS is_deleted
        FROM {events} GROUP BY event_id % 50""",
    "scenario_loss_event": """
        SELECT CAST(event_id % 50 AS BIGINT) AS scenario_id, CAST(event_id AS BIGINT) AS event_key, CAST(ts AS DATE) AS event_date, event_type AS peril_code,
               CAST(CAST(value AS DECIMAL(18,4)) AS DOUBLE) AS gu_loss, CAST(user_id AS INT) AS layer_id, CASE WHEN event_id % 17 = 0 THEN 'EUR' ELSE 'USD' END AS loss_currency,
               CAST((80 + event_id % 40) / 100.0 AS DOUBLE) AS fx_rate_to_layer_currency
        FROM {events}""",
    "scenario_layer_loss": """
        SELECT CAST(event_id % 50 AS BIGINT) AS scenario_id, CAST(user_id AS INT) AS layer_id, MIN(event_id) % 7 = 0 AS is_fhcf, CAST(1 + (MIN(event_id) % 5) / 100.0 AS DOUBLE) AS lae, 'USD' AS loss_currency,
               CAST((80 + MIN(event_id) % 40) / 100.0 AS DOUBLE) AS fx_rate_to_layer_currency, CASE WHEN MIN(event_id) % 6 = 0 THEN NULL WHEN MIN(event_id) % 6 = 1 THEN 0.0 ELSE CAST(SUM(CAST(value AS DECIMAL(18,4))) AS DOUBLE) END AS gu_loss
        FROM {events} GROUP BY event_id % 50, user_id""",
    "scenario_layer_section": """
        SELECT CAST(r_regionkey AS BIGINT) AS scenario_id, CAST(p_partkey AS BIGINT) AS layer_id, CAST(p_partkey + 1 AS BIGINT) AS section_id, CAST(p_size % 3 AS INT) AS roll_up_type, CAST(1.0 AS DOUBLE) AS fx_rate_to_parent
        FROM {part} INNER JOIN {region} ON p_partkey % 5 <> r_regionkey""",
    "scenario_layer_reinstatement": """
        SELECT CAST(r_regionkey AS BIGINT) AS scenario_id, CAST(p_partkey AS BIGINT) AS layer_id, CAST(p_partkey * 5 + r_regionkey AS INT) AS reinstatement_id, CAST(1 AS INT) AS reinstatement_order,
               CASE WHEN p_size % 4 = 0 THEN NULL ELSE CAST(p_size % 3 AS DOUBLE) END AS quantity, CAST(1.0 AS DOUBLE) AS premium_share, CAST(0.1 AS DOUBLE) AS brokerage_percentage
        FROM {part} INNER JOIN {region} ON p_partkey % 5 = r_regionkey""",
    "scenario_retro_cession": """
        SELECT CAST(r_regionkey AS BIGINT) AS scenario_id, CAST(s_suppkey AS BIGINT) AS retro_program_id, CAST(s_suppkey % 3 + 1 AS INT) AS level, CAST((s_suppkey % 50) / 100.0 AS DOUBLE) AS cession, s_name AS name
        FROM {supplier} INNER JOIN {region} ON r_regionkey < 3""",
    "scenario_retro_cession_loss": """
        SELECT CAST(event_id % 50 AS BIGINT) AS scenario_id, CAST(event_id AS VARCHAR(20)) AS event_key, CAST(user_id % 20 AS BIGINT) AS retro_program_id, 'USD' AS currency,
               CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(CAST(value AS DECIMAL(18,4)) AS DOUBLE) END AS loss
        FROM {events}""",
    "qtd": """
        SELECT CAST(l_partkey AS INT) AS layer_id, CAST(year(l_shipdate) AS INT) AS uw_year, CAST(year(l_shipdate) * 100 + 12 AS INT) AS acct_period,
               CAST(l_linenumber % 4 + 1 AS INT) AS perspective_id, CASE WHEN l_returnflag = 'A' THEN 'EUR' ELSE 'USD' END AS currency, l_linestatus AS facility,
               CAST(l_linenumber % 2 AS INT) AS rc, CAST(l_extendedprice AS DECIMAL(18,4)) AS wp, CAST(l_tax AS DECIMAL(18,4)) AS rip,
               CAST(l_quantity AS DECIMAL(18,4)) AS ep, CAST(l_discount AS DECIMAL(18,4)) AS loss_ult,
               CASE WHEN l_partkey % 7 = 1 THEN '' ELSE CONCAT('MK', CAST(l_partkey AS VARCHAR(20))) END AS master_key, CONCAT('MF', CAST(l_partkey % 10 AS VARCHAR(20))) AS master_key_from
        FROM {lineitem}""",
    "facility_segment": "SELECT DISTINCT l_linestatus AS facility, CASE WHEN l_linestatus = 'O' THEN 'Property' WHEN l_returnflag = 'A' THEN 'Casualty' ELSE 'Marine' END AS segment FROM {lineitem}",
}

#: Fixtures that are sums by a key: the source and column that the key comes from, and the key's type.
DEALT = {("retro_allocation", "layer_id"): ("lineitem", "l_partkey", "int")}


class Tables:
    """The domain tables as DataFrames, by attribute: ``Tables(spark, sf_dir).layer``. ``reader`` gives a table by its name;
    without one it is what ``spark.inuring.tables`` names, else the fixtures of one directory."""

    def __init__(self, spark: SparkSession, sf_dir: str = "", reader: Callable[[str], DataFrame] | None = None):
        self._spark, self._dir, self._reader = spark, sf_dir, reader or configured(spark)

    def dealt(self, name: str, key: str) -> DataFrame:
        """A table dealt out by a key. Where the fixture's SQL sums its source by that key, the source is dealt before the sum, so one
        shuffle serves the sum and what follows; the source's column has the key's type, else Spark wouldn't know them for the same."""
        tasks = int(self._spark.conf.get("spark.sql.shuffle.partitions"))  # by hand, as a task's rows grow while it sums and joins
        if self._reader is not None or (name, key) not in DEALT:
            return getattr(self, name).repartition(tasks, key)
        source, column, kind = DEALT[name, key]
        raw = {r: getattr(self, r) for r in RAW if f"{{{r}}}" in FIXTURES[name]}
        return self._spark.sql(FIXTURES[name], **raw | {source: raw[source].withColumn(column, raw[source][column].cast(kind)).repartition(tasks, column)})

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name in RAW:
            return self._spark.read.parquet(f"{self._dir}/{name}.parquet")
        if name not in FIXTURES:
            raise AttributeError(name)
        if self._reader is not None:
            return self._reader(name)
        raw = {r: getattr(self, r) for r in RAW if f"{{{r}}}" in FIXTURES[name]}
        return self._spark.sql(FIXTURES[name], **raw)


def dealt(t, name: str, key: str) -> DataFrame:
    """The table of that name dealt out by a key, from ``Tables`` or anything else that has tables by attribute."""
    return t.dealt(name, key) if isinstance(t, Tables) else getattr(t, name).repartition(key)


def parquet_tables(spark: SparkSession, path: str) -> Callable[[str], DataFrame]:
    """A reader of the tables in one folder, a folder or file of its name each."""
    return lambda name: spark.read.parquet(f"{path.rstrip('/')}/{name}")


def catalog_tables(spark: SparkSession, database: str) -> Callable[[str], DataFrame]:
    """A reader of the tables of a database in the session's catalog."""
    return lambda name: spark.table(f"{database}.{name}")


def configured(spark: SparkSession) -> Callable[[str], DataFrame] | None:
    """The reader that ``spark.inuring.tables`` names: ``parquet:<folder>``, ``catalog:<database>`` or ``jdbc:...`` (a URL, its
    properties under ``spark.inuring.jdbc.``, at most ``spark.inuring.parts`` connections a table); None without the setting."""
    where = spark.conf.get("spark.inuring.tables", None)
    if not where:
        return None
    kind, _, rest = where.partition(":")
    if kind == "parquet":
        return parquet_tables(spark, rest)
    if kind == "catalog":
        return catalog_tables(spark, rest)
    if kind == "jdbc":
        start = "spark.inuring.jdbc."
        properties = {k[len(start) :]: v for k, v in spark.conf.getAll.items() if k.startswith(start)}
        return jdbc_tables(spark, where, properties, parts=int(spark.conf.get("spark.inuring.parts", "16")))
    raise ValueError(f"spark.inuring.tables must begin with parquet:, catalog: or jdbc:, not {kind}:")


def with_fixtures(sql: str) -> str:
    """Oracle SQL with the domain tables that it names as common table expressions in front."""
    used = [n for n in FIXTURES if re.search(rf"\b{n}\b", sql)]
    ctes = ", ".join(f"{n} AS ({FIXTURES[n].format(**{r: r for r in RAW})})" for n in used)
    rest = sql.strip()
    if rest[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {ctes}, {rest[15:]}" if used else rest
    if rest[:5].upper() == "WITH ":
        return f"WITH {ctes}, {rest[5:]}" if used else rest
    return f"WITH {ctes} {rest}" if used else rest


#: Rows from which a table of a database is read through a further connection.
ROWS_A_PART = 100_000
#: Rows for each number from the lowest to the highest key from which ranges of keys count as even.
EVEN = 0.5


def jdbc_tables(spark: SparkSession, url: str, properties: dict[str, str], parts: int = 16, rows_a_part: int = ROWS_A_PART) -> Callable[[str], DataFrame]:
    """A reader of tables in a database, in parallel: a query for the lowest and highest value of a whole-number column and the number
    of rows tells how many parts a table has. Where the values are dense the parts are ranges of them, which an index serves; else
    they go by the remainder, which is even whatever the gaps. Filters and columns reach the database either way.
    """

    def read(name: str) -> DataFrame:
        whole = spark.read.jdbc(url, name, properties=properties)
        column = next((f.name for f in whole.schema if f.dataType.typeName() in ("integer", "long", "short")), None)
        if column is None:
            return whole
        own = spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(column)
        probe = spark.read.jdbc(url, f"(SELECT MIN({own}) AS low, MAX({own}) AS high, COUNT(*) AS n FROM {name}) probe", properties=properties).first()
        low, high, n = (int(x) if x is not None else None for x in probe)
        wanted = min(parts, -(-n // rows_a_part))
        if wanted <= 1 or low is None or low == high:
            return whole
        if n >= EVEN * (high - low + 1):
            return spark.read.jdbc(url, name, column=column, lowerBound=low, upperBound=high + 1, numPartitions=wanted, properties=properties)
        rest = lambda k: f"MOD({own}, {wanted}) IN ({k}, {k - wanted})" if k else f"MOD({own}, {wanted}) = 0 OR {own} IS NULL"
        return spark.read.jdbc(url, name, predicates=[rest(k) for k in range(wanted)], properties=properties)

    return read
