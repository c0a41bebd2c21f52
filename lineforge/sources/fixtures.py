"""Reference-shaped input tables derived from the driver's TPC-H-style parquet.

The credit-account pipeline reads nine tables (accounts, id scores, transactions from two
sources, statements, risk snapshots, fraud cases and fraud claims).  The test data ships
``customer / orders / lineitem / region`` instead, so each input is a deterministic SQL
derivation of those tables.  The same text runs as Spark SQL (with DataFrame parameters)
and, as CTEs, at the head of every DuckDB oracle, so both sides start from equal inputs.

The derivations are data shaping, not operators: the modulo rules below decide which
accounts get an id score, a snapshot or a fraud case, exactly as written in FIXTURES.md.

At scale the derived tables are written once to the shared checkpoint folder and read
back as Parquet by every query of the session, so the lineitem x orders join and the
union run once, not once per query.
"""

from __future__ import annotations

import hashlib
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import dealt_into, ensure_checkpoint_dir, parts_of, prepare

BASE_TABLES = ("customer", "orders", "lineitem", "region")

LINE_ROWS = 1 << 20  # lines of a task that joins them with their orders and sorts them by source

# ---------------------------------------------------------------------------------------
# The derivation texts of FIXTURES.md section 4 (shared with the oracle).
# ---------------------------------------------------------------------------------------
_PAY = "'00AIQZ00#%+-0QQAI0B0J1CQ0K2A0DQ0L3I0E0U4FN5GO6HP7'"
_PAY_MOD = "(case when c_custkey % 53 = 0 then 49 when c_custkey % 4 = 0 then 40 else 18 end)"
_PAY_STEPS = [(7, 0), (8, 1), (9, 4), (10, 9), (11, 16), (12, 25), (13, 36), (14, 49),
              (15, 64), (16, 81), (17, 100), (18, 121)]


def _pay_char(mult: int, add: int) -> str:
    return f"substr({_PAY}, cast(1 + (c_custkey*{mult} + {add}) % {_PAY_MOD} as int), 1)"


ACCOUNT_DIM = f"""
select concat('A', lpad(cast(c_custkey as string), 9, '0')) as current_account_nbr,
  case when c_custkey % 29 = 0 then null else concat(
    {', '.join(_pay_char(m, a) for m, a in _PAY_STEPS)}) end as payment_hist_1_12_mths,
  case when c_custkey % 10 = 0 then null else cast(date '2015-01-01' + cast(c_custkey % 3000 as int) as date) end as card_activation_date,
  case when c_custkey % 31 = 0 then 'B' when c_custkey % 37 = 0 then 'C' when c_custkey % 41 = 0 then 'X' when c_custkey % 43 = 0 then null else '0' end as external_status_reason_code,
  c_mktsegment as market_segment
from {{customer}}
"""

SYF_ID = """
select concat('A', lpad(cast(c_custkey as string), 9, '0')) as account_nbr_pty, cast((c_custkey*37) % 100 as double) / 100e0 as confidence_level
from {customer} where c_custkey % 17 <> 0
"""

_TXN_BODY = """
select concat('A', lpad(cast(o.o_custkey as string), 9, '0')) as current_account_nbr, l.l_orderkey * 10 + l.l_linenumber as transaction_id, cast(l.l_shipdate as date) as transaction_date,
  cast(l.l_extendedprice as decimal(18,2)) as transaction_amt,
  case when l.l_returnflag = 'R' and l.l_linenumber % 3 = 0 then '255' when l.l_linenumber = 7 then '254' when l.l_linenumber % 2 = 0 then '259' else '253' end as transaction_code,
  case when l.l_tax > 0.05 then cast(l.l_quantity as decimal(18,2)) else null end as curr_markup_fee,
  case l.l_suppkey % 5 when 0 then '' when 1 then null when 2 then '124' else '840' end as frgn_curr_code,
  case when l.l_linenumber = 1 then 'Y' else 'N' end as first_purchase_ind
from {lineitem} l join {orders} o on l.l_orderkey = o.o_orderkey where l.l_linestatus = """

# Both sources from one join, for storing them; the source is the line's status.
TRANSACTIONS = _TXN_BODY.replace("as first_purchase_ind\n", "as first_purchase_ind,\n"
                                 "  case l.l_linestatus when 'F' then 'transaction_fact' else 'wrld_stor_tran_fact' end as source_table\n"
                                 ).replace("where l.l_linestatus = ", "where l.l_linestatus in ('F', 'O')")
TRANSACTION_FACT = _TXN_BODY + "'F'\n"
WRLD_STOR_TRAN_FACT = _TXN_BODY + "'O'\n"

TRANSACTION_BASE = """
select *, 'transaction_fact' as source_table from {transaction_fact}
union all
select *, 'wrld_stor_tran_fact' as source_table from {wrld_stor_tran_fact}
"""

STATEMENT_FACT = """
select concat('A', lpad(cast(o_custkey as string), 9, '0')) as current_account_nbr, cast(o_orderdate as date) as billing_cycle_date,
  cast(o_totalprice as decimal(18,2)) as prev_balance, o_orderkey % 3 as return_check_cnt_total, o_orderkey % 2 as return_check_cnt_ytd,
  case when o_orderkey % 19 = 0 then 1 else 0 end as return_check_cnt_last_mth
from {orders} where o_orderstatus <> 'P'
"""

_RAMS_COLS = """
select concat('A', lpad(cast(c.c_custkey as string), 9, '0')) as cu_account_nbr, cast(date '2000-12-31' - cast(7 * r.r_regionkey as int) as date) as cu_processing_date,
  cast(case when c.c_custkey % 25 = 0 then 0 else 500 * (1 + (c.c_custkey + r.r_regionkey) % 40) end as double) as cu_crd_line,
  cast(case when c.c_custkey % 18 = 0 then 0 else c.c_acctbal end as double) as cu_cur_balance,
  cast(500 * (1 + (c.c_custkey + r.r_regionkey) % 40) as double) - c.c_acctbal as cu_otb,
  cast((c.c_custkey * 3 + r.r_regionkey) % 101 as double) as ca_current_utilz,
  cast((c.c_custkey * 5) % 101 as double) as ca_avg_utilz_lst_3_mnths, cast((c.c_custkey * 7) % 101 as double) as ca_avg_utilz_lst_6_mnths,
  case when c.c_custkey % 11 = 0 then (c.c_custkey % 7) * 15 else 0 end as cu_nbr_days_dlq,
  case when c.c_custkey % 13 = 0 then c.c_custkey % 4 else 0 end as ca_nsf_count_lst_12_months,
  case when c.c_custkey % 8 = 0 then 'Y' when c.c_custkey % 8 = 1 then 'y' when c.c_custkey % 8 = 2 then null else 'N' end as cu_line_incr_excl_flag,
  1 + c.c_custkey % 120 as ca_mob, c.c_custkey % 12 as ca_mnths_since_active, c.c_custkey % 36 as ca_mnths_since_cl_chng,
  300 + (c.c_custkey * 11) % 550 as cu_bhv_scr, 300 + (c.c_custkey * 17) % 550 as cu_crd_bureau_scr, 300 + (c.c_custkey * 19) % 550 as rb_new_bhv_scr,
  cast(c.c_custkey % 8 as string) as rb_crd_gr_new_crd_gr, cast(c.c_custkey % 50 as double) as ca_cash_bal_pct_crd_line, cast(c.c_custkey % 60 as double) as ca_cash_bal_pct_cash_line,
  1 + c.c_custkey % 3 as cu_nbr_of_plastics, cast(100 * (c.c_custkey % 20) as double) as cu_cash_line_am, c.c_custkey % 4 as cu_cur_nbr_due, c.c_custkey % 6 as ca_max_dlq_lst_6_mnths,
  cast(case when c.c_custkey % 9 = 0 then 0 else (c.c_custkey * 3 + 31) % 700 end as double) as mo_tot_sales_array_1,
  cast(case when c.c_custkey % 9 = 0 then 0 else (c.c_custkey * 4 + 62) % 700 end as double) as mo_tot_sales_array_2,
  cast(case when c.c_custkey % 9 = 0 then 0 else (c.c_custkey * 5 + 93) % 700 end as double) as mo_tot_sales_array_3,
  cast(case when c.c_custkey % 9 = 0 then 0 else (c.c_custkey * 6 + 124) % 700 end as double) as mo_tot_sales_array_4,
  cast(case when c.c_custkey % 9 = 0 then 0 else (c.c_custkey * 7 + 155) % 700 end as double) as mo_tot_sales_array_5,
  cast(case when c.c_custkey % 9 = 0 then 0 else (c.c_custkey * 8 + 186) % 700 end as double) as mo_tot_sales_array_6
"""

# Oracle form (FIXTURES.md verbatim): every customer paired with every region.
RAMS_BATCH_CUR_ORACLE = _RAMS_COLS + """from {customer} c cross join {region} r where (c.c_custkey + r.r_regionkey) % 6 <> 0 and c.c_custkey % 97 <> 0
"""

# Spark form: one snapshot slot per region key, generated per customer and matched to
# the region row by an equi-join (the region dimension is fixed at five rows).
RAMS_BATCH_CUR_SPARK = _RAMS_COLS + """from (
    select cc.*, explode(sequence((select min(r_regionkey) from {region}), (select max(r_regionkey) from {region}))) as slot
    from {customer} cc where cc.c_custkey % 97 <> 0) c
  join {region} r on r.r_regionkey = c.slot
where (c.c_custkey + r.r_regionkey) % 6 <> 0
"""

FRAUD_CLAIM_CASE = """
select concat('A', lpad(cast(o_custkey as string), 9, '0')) as current_account_nbr, cast(o_totalprice as decimal(18,2)) as gross_fraud_amt from {orders} where o_orderkey % 233 = 0
"""

FRAUD_CLAIM_TRAN = """
select current_account_nbr, transaction_date as transaction_dt, cast(transaction_amt as double) + 0.004 as transaction_am from {transaction_base} where transaction_id % 211 = 0
union all
select current_account_nbr, transaction_date, cast(transaction_amt as double) from {transaction_base} where transaction_id % 633 = 0
"""

# name -> (spark text, oracle text, dependencies); order = build order
DERIVED = {
    "account_dim": (ACCOUNT_DIM, ACCOUNT_DIM, ("customer",)),
    "syf_id": (SYF_ID, SYF_ID, ("customer",)),
    "transaction_fact": (TRANSACTION_FACT, TRANSACTION_FACT, ("lineitem", "orders")),
    "wrld_stor_tran_fact": (WRLD_STOR_TRAN_FACT, WRLD_STOR_TRAN_FACT, ("lineitem", "orders")),
    "transaction_base": (TRANSACTION_BASE, TRANSACTION_BASE, ("transaction_fact", "wrld_stor_tran_fact")),
    "statement_fact": (STATEMENT_FACT, STATEMENT_FACT, ("orders",)),
    "rams_batch_cur": (RAMS_BATCH_CUR_SPARK, RAMS_BATCH_CUR_ORACLE, ("customer", "region")),
    "fraud_claim_case": (FRAUD_CLAIM_CASE, FRAUD_CLAIM_CASE, ("orders",)),
    "fraud_claim_tran": (FRAUD_CLAIM_TRAN, FRAUD_CLAIM_TRAN, ("transaction_base",)),
}
INPUT_TABLES = tuple(DERIVED)

_ALL_NAMES = BASE_TABLES + INPUT_TABLES


def _plain(text: str) -> str:
    return text.format(**{n: n for n in _ALL_NAMES})


def oracle_ctes(*names: str) -> str:
    """``WITH`` clause (without the keyword) defining the given inputs and their deps."""
    needed: list[str] = []

    def visit(n: str) -> None:
        if n in BASE_TABLES or n in needed:
            return
        for d in DERIVED[n][2]:
            visit(d)
        needed.append(n)

    for n in names:
        visit(n)
    return ",\n".join(f"{n} AS ({_plain(DERIVED[n][1]).strip()})" for n in needed)


def read_base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def derive_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Lazy derivations (no materialisation) of the nine inputs."""
    frames: dict[str, DataFrame] = {n: read_base(spark, sf_dir, n) for n in BASE_TABLES}
    for name, (text, _, deps) in DERIVED.items():
        frames[name] = spark.sql(text, **{d: frames[d] for d in deps})
    return {n: frames[n] for n in INPUT_TABLES}


def lines_and_orders(spark: SparkSession, sf_dir: str, rows: int | None = None) -> dict[str, DataFrame]:
    """The two sides of the transactions' join, dealt by the order into parts of some ``rows`` rows, so
    that a task's sorts are bounded however few parts shuffles have."""
    sides = {n: read_base(spark, sf_dir, n) for n in ("lineitem", "orders")}
    parts = max(parts_of(df, rows or LINE_ROWS) for df in sides.values())
    return {n: dealt_into(df, parts, f"{n[0]}_orderkey") for n, df in sides.items()}


_lock = threading.Lock()
_materialised: dict[tuple[str, str], dict[str, str]] = {}
_SESSION = "lineforge.session.key"


def session_key(spark: SparkSession) -> str:
    """Names a session for good: the application, and a mark set once on the session."""
    mark = spark.conf.get(_SESSION, None)
    if not mark:
        mark = uuid.uuid4().hex
        spark.conf.set(_SESSION, mark)
    return f"{spark.sparkContext.applicationId}/{mark}"


def _paths_key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return (session_key(spark), sf_dir.rstrip("/"))


def input_tables(spark: SparkSession, sf_dir: str, materialise: bool = True) -> dict[str, DataFrame]:
    """The nine reference-shaped inputs as DataFrames.

    With ``materialise`` the derivations are written once per session and sf directory as
    Parquet under the shared checkpoint folder (lineage cut, survives executor loss) and
    every later call reads them back with full column pruning and filter pushdown.
    """
    prepare(spark)
    if not materialise:
        return derive_tables(spark, sf_dir)
    key = _paths_key(spark, sf_dir)
    with _lock:
        paths = _materialised.get(key)
        if paths is None:
            base = ensure_checkpoint_dir(spark).rstrip("/")
            tag = hashlib.sha1("|".join(key).encode()).hexdigest()[:12]
            lazy = derive_tables(spark, sf_dir)
            paths = {name: f"{base}/inputs-{tag}/{name}" for name in
                     ("account_dim", "syf_id", "transaction_base", "statement_fact", "rams_batch_cur",
                      "fraud_claim_case")}

            def write(name: str) -> None:
                # plain map-side writes: no layout shuffle (plain Parquet carries no
                # partitioning guarantee that a later plan could use)
                if name == "transaction_base":  # one join; each source in a folder of its own
                    both = spark.sql(TRANSACTIONS, **lines_and_orders(spark, sf_dir))
                    both.write.mode("overwrite").partitionBy("source_table").parquet(paths[name])
                else:
                    lazy[name].write.mode("overwrite").parquet(paths[name])

            # independent jobs: submitted together so small tables do not leave the
            # cluster idle while the transaction union is written
            from concurrent.futures import ThreadPoolExecutor
            with ThreadPoolExecutor(max_workers=len(paths)) as pool:
                list(pool.map(write, list(paths)))
            # the claims are derived from the written union, not from a second join
            tb = spark.read.parquet(paths["transaction_base"])
            claims = spark.sql(FRAUD_CLAIM_TRAN, transaction_base=tb)
            path = f"{base}/inputs-{tag}/fraud_claim_tran"
            claims.write.mode("overwrite").parquet(path)
            paths["fraud_claim_tran"] = path
            _materialised[key] = paths
    out = {n: spark.read.parquet(p) for n, p in paths.items()}
    for name in ("transaction_fact", "wrld_stor_tran_fact"):  # each is stored as it came
        out[name] = (spark.read.schema(out["transaction_base"].drop("source_table").schema)
                     .parquet(f"{paths['transaction_base']}/source_table={name}"))
    return out


def input_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Folder of a materialised input table (materialises on first use)."""
    input_tables(spark, sf_dir)
    return _materialised[_paths_key(spark, sf_dir)][name]
