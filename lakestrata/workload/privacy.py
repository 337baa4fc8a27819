"""Masking, pseudonyms, noise and column encryption."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakestrata.functions import crypto, masking
from lakestrata.functions.masking import MaskRule, mask_columns
from lakestrata.functions.permute import ROUNDS, halves
from lakestrata.functions.time import add_days, version_stamp
from lakestrata.operators.aggregates import masking_stats
from lakestrata.operators.private import private_totals, show_threshold
from lakestrata.plans.consolidate import consolidate
from lakestrata.settings import cut_lineage
from lakestrata.sources.domain import customers, domain_tables, table
from lakestrata.workload.joins import DEMO_KEY, WIDE_CUSTOMER_FIRST
from lakestrata.workload.registry import query, with_domain

NOISE_KEY = "demo-noise-key"
LINE_ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query("mask_hash", f"SELECT doc_id, sha256(text || '{DEMO_KEY}') AS text, sha256(CAST(n_chars AS VARCHAR) || '{DEMO_KEY}') AS n_chars FROM documents")
def mask_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        masking.mask_hash(F.col("text"), DEMO_KEY).alias("text"),
        masking.mask_hash(F.col("n_chars"), DEMO_KEY).alias("n_chars"),
    )


@query("mask_static", """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN '[DADO_MASCARADO]' END AS o_orderstatus FROM orders""")
def mask_static(spark, sf_dir):
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return table(spark, sf_dir, "orders").select("o_orderkey", masking.mask_static(status).alias("o_orderstatus"))


@query("mask_partial", """
SELECT conv_id, turn,
       CASE WHEN length(text) <= 7 THEN repeat('*', length(text))
            ELSE left(text, 3) || repeat('*', length(text) - 7) || right(text, 4) END AS text,
       CASE WHEN length(role) <= 5 THEN repeat('#', length(role))
            ELSE left(role, 5) || repeat('#', length(role) - 5) END AS role
FROM conversations""")
def mask_partial(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn",
        masking.mask_partial(F.col("text"), 3, 4).alias("text"),
        masking.mask_partial(F.col("role"), 5, 0, "#").alias("role"),
    )


def _sql_list(words):
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _digest(kind):
    return f"sha256('{DEMO_KEY}|{kind}|' || c_name)"


def _number(kind, slot):
    return f"CAST('0x' || substr({_digest(kind)}, {slot * 8 + 1}, 8) AS BIGINT)"


def _word(words, kind, slot):
    return f"{_sql_list(words)}[{_number(kind, slot)} % {len(words)} + 1]"


def _digits(kind, slot, width):
    return f"lpad(CAST({_number(kind, slot)} % {10 ** width} AS VARCHAR), {width}, '0')"


def _check_digit(column, length):
    terms = " + ".join(f"CAST(substr({column}, {i + 1}, 1) AS BIGINT) * {length + 1 - i}" for i in range(length))
    return f"CAST(({terms}) * 10 % 11 % 10 AS VARCHAR)"


PSEUDONYM_SQL = f"""
WITH c AS (SELECT c_custkey, c_name, {_digits('cpf', 0, 9)} AS nine FROM customer),
t AS (SELECT *, nine || {_check_digit('nine', 9)} AS ten FROM c),
e AS (SELECT *, ten || {_check_digit('ten', 10)} AS eleven FROM t)
SELECT c_custkey,
  {_word(masking.FIRST_NAMES, 'name', 0)} || ' ' || {_word(masking.LAST_NAMES, 'name', 1)} AS nome,
  lower({_word(masking.FIRST_NAMES, 'email', 0)}) || '.' || lower({_word(masking.LAST_NAMES, 'email', 1)})
    || {_digits('email', 2, 6)} || '@example.com.br' AS email,
  {_word(masking.STREETS, 'address', 0)} || ', ' || CAST({_number('address', 1)} % 2000 + 1 AS VARCHAR) || ' - '
    || {_digits('address', 2, 8)} AS endereco,
  '+55 ' || {_word(masking.AREA_CODES, 'phone', 0)} || ' 9' || {_digits('phone', 1, 4)} || '-'
    || {_digits('phone', 2, 4)} AS telefone,
  substr(eleven, 1, 3) || '.' || substr(eleven, 4, 3) || '.' || substr(eleven, 7, 3) || '-' || substr(eleven, 10, 2) AS cpf,
  {_word(masking.WORDS, 'apelido', 0)} AS apelido
FROM e"""


@query("mask_pseudonym", PSEUDONYM_SQL)
def mask_pseudonym(spark, sf_dir):
    name = F.col("c_name")
    columns = ["nome", "email", "endereco", "telefone", "cpf", "apelido"]
    copies = table(spark, sf_dir, "customer").select("c_custkey", *[name.alias(c) for c in columns])
    return mask_columns(copies, {c: MaskRule("fake") for c in columns}, key=DEMO_KEY)


def _rounds_sql(source, number, a, b, key, name):
    """CTEs of the rounds; the last one is ``name`` with the number ``p``."""
    parts = [f"{name}_0 AS (SELECT *, {number} % {a} AS fl, {number} // {a} AS fr FROM {source})"]
    for k in range(ROUNDS):
        digest = lambda half: f"CAST('0x' || substr(sha256('{key}|{k}|' || CAST({half} AS VARCHAR)), 1, 13) AS BIGINT)"
        fl, fr = (f"(fl + {digest('fr')}) % {a}", "fr") if k % 2 == 0 else ("fl", f"(fr + {digest('fl')}) % {b}")
        parts.append(f"{name}_{k + 1} AS (SELECT * EXCLUDE (fl, fr), {fl} AS fl, {fr} AS fr FROM {name}_{k})")
    return ", ".join([*parts, f"{name} AS (SELECT * EXCLUDE (fl, fr), fl + fr * {a} AS p FROM {name}_{ROUNDS})"])


def _permuted_sql():
    nine, eight = halves(10 ** 9), halves(10 ** 8)
    return f"""
WITH src AS (SELECT c_custkey FROM customer),
{_rounds_sql('src', 'CAST(c_custkey AS BIGINT)', *nine, DEMO_KEY + '|cpf', 'c')},
{_rounds_sql('c', 'CAST(c_custkey AS BIGINT)', *nine, DEMO_KEY + '|numbered|9', 'm').replace('p FROM m', 'code FROM m')},
{_rounds_sql('m', 'CAST(c_custkey AS BIGINT)', *eight, DEMO_KEY + '|phone', 'f').replace('p FROM f', 'phone FROM f')},
t AS (SELECT *, lpad(CAST(p AS VARCHAR), 9, '0') AS nine, lpad(CAST(phone AS VARCHAR), 8, '0') AS eight FROM f),
u AS (SELECT *, nine || {_check_digit('nine', 9)} AS ten FROM t),
e AS (SELECT *, ten || {_check_digit('ten', 10)} AS eleven FROM u)
SELECT c_custkey, substr(eleven, 1, 3) || '.' || substr(eleven, 4, 3) || '.' || substr(eleven, 7, 3) || '-' || substr(eleven, 10, 2) AS cpf,
  'Customer#' || lpad(CAST(code AS VARCHAR), 9, '0') AS code,
  '+55 11 9' || left(eight, 4) || '-' || right(eight, 4) AS telefone
FROM e"""


@query("mask_permuted", _permuted_sql())
def mask_permuted(spark, sf_dir):
    """Pseudonyms by keyed permutation: as many of them as there are values."""
    key = F.lpad(F.col("c_custkey").cast("string"), 9, "0")
    phone = F.concat(F.lit("+55 11 9"), F.substring(key, 2, 4), F.lit(" "), F.right(key, F.lit(4)))
    # Thirty digests a row: a file of few row groups is dealt to all cores first.
    dealt = table(spark, sf_dir, "customer").select("c_custkey").repartition(spark.sparkContext.defaultParallelism)
    copies = dealt.select(
        "c_custkey", F.concat(key, F.lit("00")).alias("cpf"), F.concat(F.lit("Customer#"), key).alias("code"), phone.alias("telefone"),
    )
    policy = {c: MaskRule("permuted", {"kind": k}) for c, k in (("cpf", "cpf"), ("code", "numbered"), ("telefone", "phone"))}
    return mask_columns(copies, policy, key=DEMO_KEY)


@query("mask_policy", with_domain(f"""
SELECT * REPLACE (CASE WHEN customer_city IS NOT NULL THEN '[CIDADE_REMOVIDA_LGPD]' END AS customer_city,
                  sha256(customer_state || '{DEMO_KEY}') AS customer_state)
FROM ({WIDE_CUSTOMER_FIRST})"""))
def mask_policy(spark, sf_dir):
    """The default policy over the whole consolidated table."""
    return mask_columns(consolidate(domain_tables(spark, sf_dir)), key=DEMO_KEY)


@query("masking_stats", with_domain("""
SELECT 'customer_city' AS "column", count(DISTINCT customer_city) AS original_unique, CAST(1 AS BIGINT) AS masked_unique FROM d_customers
UNION ALL SELECT 'customer_state', count(DISTINCT customer_state), count(DISTINCT customer_state) FROM d_customers"""))
def stats(spark, sf_dir):
    before = customers(spark, sf_dir)
    return masking_stats(before, mask_columns(before, key=DEMO_KEY), ["customer_city", "customer_state"])


@query("dp_noise_keyed", f"""
WITH u AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
  (CAST('0x' || substr(sha256(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)) || '{NOISE_KEY}'), 1, 13) AS BIGINT) + 0.5::DOUBLE)
    / 4503599627370496.0::DOUBLE - 0.5::DOUBLE AS u FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  round(l_quantity - sign(u) * ln(greatest(1 - 2 * abs(u), 1.1102230246251565e-16)) * 2.0::DOUBLE, 6) AS l_quantity FROM u""")
def dp_noise_keyed(spark, sf_dir):
    """Repeatable noise drawn from a keyed digest of the line's identity."""
    lines = table(spark, sf_dir, "lineitem").select(*LINE_ID, "l_quantity")
    noisy = masking.laplace_noise(lines, "l_quantity", 0.5, 1.0, noise_key=(LINE_ID, NOISE_KEY))
    return noisy.withColumn("l_quantity", F.round("l_quantity", 6))


@query("dp_noise")
def dp_noise(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return masking.laplace_noise(lines, "l_quantity", 0.5, 1.0, seed=42)


@query("dp_noise_statistics", """
SELECT count(*) AS n, true AS unbiased, true AS spread_as_asked, true AS rows_differ FROM lineitem""")
def dp_noise_statistics(spark, sf_dir):
    """The random noise itself: its mean and spread over the whole table."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    noise = masking.laplace_noise(lines.withColumn("l_quantity", F.lit(0.0)), "l_quantity", 0.5, 1.0, seed=42)
    # Laplace(0, 2) has the standard deviation 2.83; its mean over n rows varies by 2.83 / sqrt(n).
    n, spread = F.count(F.lit(1)), 8 ** 0.5
    return noise.agg(
        n.alias("n"), (F.abs(F.avg("l_quantity")) < 5 * spread / F.sqrt(n)).alias("unbiased"),
        (F.abs(F.stddev("l_quantity") / spread - 1) < 10 / F.sqrt(n)).alias("spread_as_asked"),
        (F.approx_count_distinct("l_quantity") > 0.8 * n).alias("rows_differ"),
    )


_UNIT = "(CAST('0x' || substr(sha256({text}), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE - 0.5::DOUBLE"
_LAPLACE = "-sign({u}) * ln(greatest(1 - 2 * abs({u}), 1.1102230246251565e-16)) * {scale}::DOUBLE"
PRIVATE = {"epsilon": 1.0, "low": 0.0, "high": 200_000.0, "most_rows": 3, "delta": 1e-6}


@query("private_totals", f"""
WITH ranked AS (
  SELECT o_orderpriority, greatest(0, least(200000, CAST(o_totalprice AS DOUBLE))) AS x, row_number() OVER (
    PARTITION BY o_custkey ORDER BY sha256(CAST(o_orderkey AS VARCHAR) || '{NOISE_KEY}'), o_orderkey) AS k FROM orders),
sums AS (SELECT o_orderpriority, count(*) AS n, sum(x) AS s FROM ranked WHERE k <= 3 GROUP BY o_orderpriority),
units AS (SELECT *, {_UNIT.format(text=f"o_orderpriority || '{NOISE_KEY}|_n'")} AS un, {_UNIT.format(text=f"o_orderpriority || '{NOISE_KEY}|_s'")} AS us FROM sums),
noisy AS (SELECT o_orderpriority, n + {_LAPLACE.format(u='un', scale=6.0)} AS n_rows, s + {_LAPLACE.format(u='us', scale=1_200_000.0)} AS total FROM units)
SELECT o_orderpriority, round(n_rows, 3) AS n_rows, round(total, 1) AS total, round(total / n_rows, 2) AS mean
FROM noisy WHERE n_rows >= {show_threshold(0.5, 3, 1e-6)!r}""")
def private_totals_(spark, sf_dir):
    """Orders per priority, each customer with three orders at most."""
    shown = private_totals(
        table(spark, sf_dir, "orders"), "o_orderpriority", "o_custkey", "o_totalprice", secret=NOISE_KEY,
        row_id=["o_orderkey"], **PRIVATE,
    )
    return shown.select(
        "o_orderpriority", F.round("n_rows", 3).alias("n_rows"), F.round("total", 1).alias("total"), F.round("mean", 2).alias("mean")
    )


def demo_keys(spark, sf_dir):
    """Key history derived from the regions: one version per region."""
    region = table(spark, sf_dir, "region")
    created = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_interval(days=F.col("r_regionkey") * 10)
    return region.select(
        F.concat(F.lit("v"), F.col("r_regionkey").cast("string")).alias("version"),
        F.unhex(F.sha2("r_name", 256)).alias("key_value"),
        created.alias("created_at"),
        (created + F.make_interval(days=F.lit(90))).alias("expires_at"),
    )


@query("encrypt_roundtrip", "SELECT doc_id, text, 'v1' AS key_version FROM documents")
def encrypt_roundtrip(spark, sf_dir):
    """Whole texts are stored encrypted, then read back and decrypted."""
    keys = demo_keys(spark, sf_dir)
    secret = crypto.encrypt_column(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", keys, "v1")
    return crypto.decrypt_column(cut_lineage(secret, "encrypted"), "text", keys)


@query("rekey_roundtrip", """
SELECT c_custkey, c_name, CASE WHEN c_nationkey < 10 THEN 'v3' ELSE 'v2' END AS key_version FROM customer""")
def rekey_roundtrip(spark, sf_dir):
    """Two versions in one table; one of them is re-encrypted under a third."""
    keys = demo_keys(spark, sf_dir)
    customer = table(spark, sf_dir, "customer")
    old = crypto.encrypt_column(customer.where("c_nationkey < 10").select("c_custkey", "c_name"), "c_name", keys, "v1")
    current = crypto.encrypt_column(
        customer.where("c_nationkey >= 10").select("c_custkey", "c_name"), "c_name", keys, "v2"
    )
    return crypto.decrypt_column(crypto.rekey(old.unionByName(current), "c_name", keys, "v3", "v1"), "c_name", keys)


@query("expired_keys", """
SELECT DISTINCT 'v' || strftime(o_orderdate, '%Y%m%d%H%M%S') AS version, o_orderdate AS created_at FROM orders
WHERE o_orderdate < TIMESTAMP '1999-01-31 00:00:00' - INTERVAL 90 DAY AND o_orderdate <> TIMESTAMP '1998-01-05 00:00:00'""")
def expired(spark, sf_dir):
    """A key history with one version per order day; one old key is still active."""
    created = F.col("o_orderdate")
    keys = table(spark, sf_dir, "orders").select(
        version_stamp(created).alias("version"), created.alias("created_at"),
        add_days(created, 90).alias("expires_at"),
    ).distinct()
    old = crypto.expired_keys(keys, 90, "1999-01-31 00:00:00", active="v19980105000000")
    return old.select("version", "created_at")
