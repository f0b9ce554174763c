"""Independent SQL for every registered query, runnable by DuckDB.

The prefix re-derives the banking tables from the test tables (the views of
FIXTURES.md section 3, which ran unchanged in both engines); each query then
states the reference's SQL over them. Money sums are exact in both
engines (DECIMAL sum cast to DOUBLE), integer sums are cast to BIGINT, and
sorted queries with a limit carry key tie-breaks.
"""

from __future__ import annotations

from ..sources.testbridge import BATCH_DATE
from .scenarios import ASOF_FORMS, BATCH_A, BATCH_B, CUTOFF

RAW_VIEWS = [
    ("raw_branches", """select 'BR'||printf('%05d', n_nationkey) branch_id, n_name||' Main Branch' branch_name, case when n_nationkey=24 then null else n_name end city, 'ST'||cast(n_nationkey%7 as string) state, r_name region
from nation join region on n_regionkey=r_regionkey"""),
    ("raw_merchants", """select 'M'||printf('%06d', s_suppkey) merchant_id, s_name merchant_name, case s_suppkey%8 when 0 then 'GROCERY' when 1 then 'TRAVEL' when 2 then 'FUEL' when 3 then 'DINING' when 4 then 'SHOPPING' when 5 then 'UTILITIES' when 6 then 'CASH' else 'SALARY' end merchant_category, case when s_suppkey%20=19 then null else case s_suppkey%4 when 0 then 'LOW' when 1 then 'LOW' when 2 then 'MEDIUM' else 'HIGH' end end risk_level
from supplier
union all select 'M999999', 'Idle', 'IDLE', 'LOW'"""),
    ("raw_customers", """select 'C'||printf('%08d', c_custkey) customer_id, c_name first_name, case when c_custkey%17=0 then null else c_mktsegment end last_name, 'CITY'||cast(c_custkey%8 as string) city, 'ST'||cast(c_custkey%7 as string) state, case when c_custkey%50=0 then null else case c_custkey%3 when 0 then 'REJECTED' when 1 then 'PENDING' else 'VERIFIED' end end kyc_status, c_mktsegment customer_segment, 'BR'||printf('%05d', c_nationkey) home_branch_id, cast(date '2016-01-01' + cast(c_custkey%3651 as int) as date) created_at
from customer
union all select 'C99999999', 'Idle', null, 'CITY0', 'ST0', 'VERIFIED', 'IDLE', 'BR00001', date '2016-01-01'"""),
    ("raw_accounts", """select 'A'||printf('%09d', c_custkey) account_id, 'C'||printf('%08d', c_custkey) customer_id, case when c_custkey%101=0 then null else 'BR'||printf('%05d', (c_custkey*7)%27) end branch_id, c_mktsegment account_type, case c_custkey%5 when 0 then 'ACTIVE' when 1 then 'ACTIVE' when 2 then 'ACTIVE' when 3 then 'DORMANT' else 'CLOSED' end account_status, cast(date '2017-01-01' + cast(c_custkey%3201 as int) as date) open_date, case when c_custkey%67=0 then null else c_acctbal*150 end current_balance
from customer"""),
    ("raw_cards", """select 'CARD'||printf('%09d', c_custkey - c_custkey%2) card_id, 'A'||printf('%09d', c_custkey) account_id, case c_custkey%3 when 0 then 'DEBIT' when 1 then 'CREDIT' else 'PREPAID' end card_type, case when c_custkey%13=0 then null when c_custkey%3=2 then 'BLOCKED' else 'ACTIVE' end card_status, cast(date '2017-01-01' + cast(c_custkey%3201 as int) as date) issued_date
from customer where c_custkey%10<7"""),
    ("raw_loan_applications", """select 'L'||printf('%08d', o_orderkey) application_id, 'C'||printf('%08d', o_custkey) customer_id, cast(o_orderdate as date) application_date, case o_orderkey%4 when 0 then 'HOME' when 1 then 'AUTO' when 2 then 'PERSONAL' else 'BUSINESS' end loan_type, case when o_orderkey%29=0 then null else o_totalprice*20 end requested_amount, case o_orderstatus when 'F' then 'REJECTED' when 'O' then 'APPROVED' else 'SUBMITTED' end application_status
from orders"""),
    ("raw_transactions", """select 'T'||printf('%010d', l_orderkey)||cast(l_linenumber as string) transaction_id, 'A'||printf('%09d', o_custkey) account_id, 'C'||printf('%08d', o_custkey) customer_id, 'M'||printf('%06d', l_suppkey) merchant_id, l_shipdate transaction_ts, case when l_returnflag='R' then 'CREDIT' else 'DEBIT' end transaction_type, case l_linenumber%6 when 0 then 'ATM' when 1 then 'UPI' when 2 then 'POS' when 3 then 'NETBANKING' when 4 then 'MOBILE' else 'BRANCH' end channel, case l_partkey%8 when 0 then 'GROCERY' when 1 then 'TRAVEL' when 2 then 'FUEL' when 3 then 'DINING' when 4 then 'SHOPPING' when 5 then 'UTILITIES' when 6 then 'CASH' else 'SALARY' end category, case when l_partkey%97=0 then null else l_extendedprice*2 end amount, 'INR' currency, case o_orderstatus when 'F' then 'FAILED' when 'O' then 'SUCCESS' else 'REVERSED' end status, case when l_orderkey%11=0 then null else (l_orderkey+l_linenumber)%5=0 end is_suspected_fraud, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus
from lineitem join orders on l_orderkey=o_orderkey"""),
]

B = f"'{BATCH_DATE}'"


def _val(name, cols, key, order, source, where="", batch=B):
    return (name, f"""select {cols}, {batch} batch_date
from (select *, row_number() over (partition by {key} order by {order}) rn from {source} where {where}) t where rn=1""")


TXN_COLS = ("transaction_id, account_id, customer_id, merchant_id, transaction_ts, transaction_type, "
            "channel, category, amount, currency, status, is_suspected_fraud")
TXN_REQUIRED = ("transaction_id is not null and account_id is not null and customer_id is not null "
                "and amount is not null")
TXN_ORDER = ("transaction_ts desc, l_suppkey, l_partkey, amount, l_quantity, l_discount, l_tax, "
             "l_returnflag, l_linestatus")

VAL_VIEWS = [
    _val("val_branches", "branch_id, branch_name, city, state, region", "branch_id", "branch_name",
         "raw_branches", "branch_id is not null and city is not null and region is not null"),
    _val("val_merchants", "merchant_id, merchant_name, merchant_category, risk_level", "merchant_id",
         "merchant_name", "raw_merchants",
         "merchant_id is not null and merchant_category is not null and risk_level is not null"),
    _val("val_customers", "customer_id, first_name, last_name, city, state, kyc_status, "
         "customer_segment, home_branch_id, created_at", "customer_id", "first_name", "raw_customers",
         "customer_id is not null and kyc_status is not null and home_branch_id is not null"),
    _val("val_accounts", "account_id, customer_id, branch_id, account_type, account_status, open_date, "
         "current_balance", "account_id", "customer_id", "raw_accounts",
         "account_id is not null and customer_id is not null and branch_id is not null"),
    _val("val_cards", "card_id, account_id, card_type, card_status, issued_date", "card_id",
         "account_id", "raw_cards",
         "card_id is not null and account_id is not null and card_status is not null"),
    _val("val_loan_applications", "application_id, customer_id, application_date, loan_type, "
         "requested_amount, application_status", "application_id", "customer_id",
         "raw_loan_applications",
         "application_id is not null and customer_id is not null and requested_amount is not null"),
    _val("val_transactions", TXN_COLS, "transaction_id", TXN_ORDER, "raw_transactions", TXN_REQUIRED),
]


def _fact(name: str, val: str):
    return (name, f"""select t.transaction_id, t.account_id, t.customer_id, t.merchant_id, t.transaction_ts, cast(t.transaction_ts as date) transaction_date, t.transaction_type, t.channel, t.category, t.amount, t.currency, t.status, t.is_suspected_fraud, case when t.is_suspected_fraud then 'HIGH' when m.risk_level='HIGH' then 'HIGH' when t.amount>=100000 then 'MEDIUM' else 'LOW' end transaction_risk_band, t.batch_date
from {val} t left join val_merchants m on t.merchant_id=m.merchant_id""")


CURATED_VIEWS = [
    ("dim_customers", """select customer_id, concat_ws(' ', first_name, last_name) customer_name, city, state, kyc_status, customer_segment, home_branch_id, created_at, batch_date, case when kyc_status='REJECTED' then 'HIGH' when kyc_status='PENDING' then 'MEDIUM' else 'LOW' end customer_risk_band
from val_customers"""),
    ("dim_accounts", """select account_id, customer_id, branch_id, account_type, account_status, open_date, current_balance, batch_date, case when current_balance>=1000000 then 'HIGH' when current_balance>=100000 then 'MEDIUM' else 'LOW' end balance_band
from val_accounts"""),
    _fact("fact_transactions", "val_transactions"),
]

# The two-batch scenario: events before the cutoff arrive in batch A, the
# rest in batch B; keys that recur on both sides are updates, most of them
# moving to another date partition.
CUT = f"timestamp '{CUTOFF} 00:00:00'"
SCENARIO_VIEWS = [
    _val("val_txn_a", TXN_COLS, "transaction_id", TXN_ORDER, "raw_transactions",
         f"{TXN_REQUIRED} and transaction_ts < {CUT}", f"'{BATCH_A}'"),
    _val("val_txn_b", TXN_COLS, "transaction_id", TXN_ORDER, "raw_transactions",
         f"{TXN_REQUIRED} and transaction_ts >= {CUT}", f"'{BATCH_B}'"),
    _fact("fact_a", "val_txn_a"),
    _fact("fact_b", "val_txn_b"),
    ("raw_low", """select * replace (amount - 1 as amount) from raw_transactions"""),
    _val("val_low", TXN_COLS, "transaction_id", TXN_ORDER, "raw_low", TXN_REQUIRED),
    _val("val_corrected", TXN_COLS, "transaction_id", TXN_ORDER, "raw_transactions",
         f"{TXN_REQUIRED} and l_partkey % 3 <> 0"),
    _fact("fact_low", "val_low"),
    _fact("fact_corrected", "val_corrected"),
    ("fact_rerun", """select * from fact_low a where not exists (select 1 from fact_corrected b where b.transaction_id = a.transaction_id)
union all select * from fact_corrected"""),
    ("fact_merged", """select * from fact_a a where not exists (select 1 from fact_b b where b.transaction_id = a.transaction_id)
union all select * from fact_b"""),
]

ALL_VIEWS = RAW_VIEWS + VAL_VIEWS + CURATED_VIEWS + SCENARIO_VIEWS


def with_views(body: str) -> str:
    """``body`` preceded by every derivation view as a CTE (DuckDB drops unused ones)."""
    ctes = ",\n".join(f"{name} as (\n{sql}\n)" for name, sql in ALL_VIEWS)
    return f"with {ctes}\n{body}"


MONEY = "cast(sum(cast({} as decimal(28,6))) as double)"


def _m(col: str) -> str:
    return MONEY.format(col)


FACT_SELECT = ("transaction_id, account_id, customer_id, merchant_id, transaction_ts, "
               "transaction_date, transaction_type, channel, category, amount, currency, status, "
               "is_suspected_fraud, transaction_risk_band, batch_date")

BODIES: dict[str, str] = {
    **{f"validate_{d}": f"select * from val_{d}" for d in
       ("customers", "accounts", "transactions", "merchants", "branches", "cards",
        "loan_applications")},
    "dedupe_by_key": f"""select v.transaction_id, v.transaction_ts, v.amount, d.copies
from val_transactions v join (select transaction_id, count(*) as copies from raw_transactions
  where {TXN_REQUIRED} group by transaction_id having count(*) > 1) d on v.transaction_id = d.transaction_id""",
    "zone_roundtrip": "select * from val_transactions",
    "transform_customers": "select * from dim_customers",
    "transform_accounts": "select * from dim_accounts",
    "transform_transactions": "select * from fact_transactions",
    "load_dim_customers": "select * from dim_customers",
    "load_dim_accounts": "select * from dim_accounts",
    "load_dim_merchants": "select * from val_merchants",
    "load_dim_branches": "select * from val_branches",
    "merge_transactions": f"select {FACT_SELECT} from fact_merged",
    "merge_idempotent": f"select {FACT_SELECT} from fact_merged",
    "merge_partition_move": """select transaction_date, count(*) as transaction_count
from fact_merged group by transaction_date""",
    "merge_corrected_rerun": f"select {FACT_SELECT} from fact_rerun",
    "incremental_upsert": f"select {FACT_SELECT} from fact_merged",
    "incremental_upsert_split": f"select {FACT_SELECT} from fact_merged",
    "asof_fact": f"select {FACT_SELECT} from fact_a",
    "asof_forms": "\nunion all ".join(
        f"select '{at}' as as_of, " + (f"(select count(*) from {table})" if table else "cast(0 as bigint)")
        + " as transaction_count" for at, table in zip(ASOF_FORMS, (
            None, None, "fact_a", None, "fact_a", "fact_a", "fact_a", "fact_merged"))),
    "asof_count": "select count(*) as transaction_count from fact_a",
    "daily_branch_summary": f"""select f.transaction_date, b.region, b.state, b.city,
  count(*) as transaction_count, {_m('f.amount')} as total_amount,
  cast(sum(case when f.transaction_risk_band = 'HIGH' then 1 else 0 end) as bigint) as high_risk_count
from fact_transactions f join dim_accounts a on f.account_id = a.account_id
join val_branches b on a.branch_id = b.branch_id
group by f.transaction_date, b.region, b.state, b.city""",
    "customer_risk_summary": f"""select c.customer_segment, c.customer_risk_band,
  count(distinct c.customer_id) as customer_count, count(f.transaction_id) as transaction_count,
  {_m('f.amount')} as total_transaction_amount
from dim_customers c left join fact_transactions f on c.customer_id = f.customer_id
group by c.customer_segment, c.customer_risk_band""",
    "merchant_spend_summary": f"""select m.merchant_category, m.risk_level,
  count(f.transaction_id) as transaction_count, {_m('f.amount')} as total_amount
from val_merchants m left join fact_transactions f on m.merchant_id = f.merchant_id
group by m.merchant_category, m.risk_level""",
    "account_balance_snapshot": f"""select account_type, account_status, balance_band,
  count(*) as account_count, {_m('current_balance')} as total_balance,
  {_m('current_balance')} / count(current_balance) as average_balance
from dim_accounts group by account_type, account_status, balance_band""",
    "daily_channel_volume": f"""select transaction_date, channel, count(*) as transaction_count,
  {_m('amount')} as total_amount
from fact_transactions group by transaction_date, channel
order by transaction_date desc, total_amount desc""",
    "high_risk_merchants": f"""select m.merchant_category, m.risk_level,
  count(f.transaction_id) as transaction_count, {_m('f.amount')} as total_amount
from fact_transactions f join val_merchants m on f.merchant_id = m.merchant_id
where f.transaction_risk_band = 'HIGH'
group by m.merchant_category, m.risk_level order by total_amount desc""",
    "top_branch_regions": f"""select b.region, b.state, b.city, count(*) as transaction_count,
  {_m('f.amount')} as total_amount
from fact_transactions f join dim_accounts a on f.account_id = a.account_id
join val_branches b on a.branch_id = b.branch_id
group by b.region, b.state, b.city
order by total_amount desc nulls last, b.region asc nulls last, b.state asc nulls last,
  b.city asc nulls last
limit 20""",
    "customer_risk_ranked": f"""select c.customer_segment, c.customer_risk_band,
  count(distinct c.customer_id) as customer_count, count(f.transaction_id) as transaction_count,
  {_m('f.amount')} as total_transaction_amount
from dim_customers c left join fact_transactions f on c.customer_id = f.customer_id
group by c.customer_segment, c.customer_risk_band order by total_transaction_amount desc""",
    "check_fact_count": "select count(*) as transaction_count from fact_transactions",
    "check_by_date": f"""select transaction_date, count(*) as transaction_count,
  {_m('amount')} as total_amount
from fact_transactions group by transaction_date order by transaction_date desc""",
    "check_risk_band": """select transaction_risk_band, count(*) as transaction_count
from fact_transactions group by transaction_risk_band""",
    "check_risk_band_rows": """select transaction_risk_band, count(*) as row_count
from fact_transactions group by transaction_risk_band""",
    "check_high_risk_success": """select count(*) as high_risk_success_txns from fact_transactions
where transaction_risk_band = 'HIGH' and status = 'SUCCESS'""",
    "check_customer_count": "select count(*) as customer_count from dim_customers",
    "check_account_count": "select count(*) as account_count from dim_accounts",
    "quality_report": """select 'fact_transactions' as check_name, count(*) as value from fact_transactions
union all select 'high_risk_success', count(*) from fact_transactions where transaction_risk_band = 'HIGH' and status = 'SUCCESS'
union all select 'dim_customers', count(*) from dim_customers
union all select 'dim_accounts', count(*) from dim_accounts""",
    "batch_completeness": """select 'branches' as dataset, true as file_present, count(*) as row_count from raw_branches
union all select 'merchants', true, count(*) from raw_merchants
union all select 'customers', true, count(*) from raw_customers
union all select 'accounts', true, count(*) from raw_accounts
union all select 'cards', true, count(*) from raw_cards
union all select 'transactions', true, count(*) from raw_transactions
union all select 'loan_applications', true, count(*) from raw_loan_applications""",
}
for _report in ("daily_channel_volume", "high_risk_merchants", "top_branch_regions", "customer_risk_ranked", "asof_count"):
    BODIES[f"sql_{_report}"] = BODIES[_report]
BODIES["export_roundtrip"] = BODIES["customer_risk_ranked"]
BODIES["partial_batch_completeness"] = """select 'branches' as dataset, true as file_present, count(*) as row_count from raw_branches
union all select 'merchants', false, 0
union all select 'customers', true, count(*) from raw_customers
union all select 'accounts', false, 0
union all select 'cards', true, 0
union all select 'transactions', false, 0
union all select 'loan_applications', false, 0"""


def oracle_sql() -> dict[str, str]:
    from ..sources.synth import SQL as SYNTH_SQL
    return {**{name: with_views(body) for name, body in BODIES.items()}, **SYNTH_SQL}
