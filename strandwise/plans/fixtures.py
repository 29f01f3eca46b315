"""Sequence tables derived from the driver's tables, in SQL that Spark and other
engines read alike. Each view may use those before it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages")
_ACGT = "'0123456789abcdef', 'ACGTACGTACGTACGT'"
#: Forward primers and reverse complements of the reverse primers, by marker.
PRIMERS = {"M0": ("ACGTTGCAAC", "CTAAGGATCC"), "M1": ("GGATCAGTCA", "TTGACCAGAT"), "M2": ("TCAGGTACCA", "AACGTGGTCT")}


def _case(column: str, side: int) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{m}' THEN '{p[side]}'" for m, p in PRIMERS.items()) + " END"


def _bases(key: str, n: str) -> str:
    return f"substr(translate(concat(md5({key}), md5(concat('x', {key}))), {_ACGT}), 1, {n})"


VIEWS = {
    "alleles": "SELECT concat('M', m, '-', a) AS name, concat('M', m) AS marker, " + _bases("concat('M', m, '-', a)", "60") + " AS seq FROM (SELECT DISTINCT CAST(l_partkey % 3 AS INT) AS m, CAST(l_orderkey % 5 AS INT) AS a FROM lineitem)",
    "samples": f"SELECT sample, substr(translate(md5(concat('tag', sample)), {_ACGT}), 1, 6) AS tag FROM (SELECT DISTINCT concat('S', l_suppkey % 12) AS sample FROM lineitem)",
    "inserts": f"""SELECT read_id, sample, marker, run, strand, tax, tag, primer_f, primer_rc,
  CASE WHEN q % 10 = 0 THEN concat(substr(allele, 1, ln * 8 - 1), translate(substr(allele, ln * 8, 1), 'ACGT', 'CGTA'), substr(allele, ln * 8 + 1))
       WHEN q % 50 = 7 THEN concat(substr(allele, 1, 29), substr(other, 30))
       WHEN q % 50 = 11 THEN concat(substr(allele, 1, 20), substr(allele, 22)) ELSE allele END AS seq FROM (
  SELECT md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS BIGINT), CAST(round(l_extendedprice * 100) AS BIGINT))) AS read_id,
    sample, marker, l_linestatus AS run, l_returnflag AS strand, CAST(round(l_tax * 100) AS INT) AS tax, l_linenumber AS ln, CAST(l_quantity AS INT) AS q,
    substr(translate(md5(concat('tag', sample)), {_ACGT}), 1, 6) AS tag, {_case('marker', 0)} AS primer_f, {_case('marker', 1)} AS primer_rc,
    {_bases("concat(marker, '-', a)", '60')} AS allele, {_bases("concat(marker, '-0')", '60')} AS other FROM (
    SELECT *, concat('S', l_suppkey % 12) AS sample, concat('M', l_partkey % 3) AS marker,
      CASE WHEN l_orderkey % 20 < 10 THEN 0 WHEN l_orderkey % 20 < 15 THEN 1 WHEN l_orderkey % 20 < 18 THEN 2 WHEN l_orderkey % 20 < 19 THEN 3 ELSE 4 END AS a FROM lineitem))""",
    "reads": """SELECT read_id, CASE WHEN strand = 'R' THEN reverse(translate(whole, 'ACGT', 'TGCA')) ELSE whole END AS seq,
  repeat(substr('5:?DI', tax % 5 + 1, 1), CAST(length(whole) AS INT)) AS qual, sample, marker, run FROM (SELECT *, concat(tag, primer_f, seq, primer_rc) AS whole FROM inserts)""",
    "variants": "SELECT marker, sample, md5(seq) AS md5, seq, count(*) AS depth FROM inserts GROUP BY marker, sample, seq",
    "members": """SELECT marker, sample, CAST(instr('ACGT', substr(seq, 60, 1)) AS INT) AS cluster, CASE WHEN row_number() OVER (PARTITION BY marker, sample, instr('ACGT', substr(seq, 60, 1)) ORDER BY depth DESC, md5) = 1 THEN 'head' ELSE 'member' END AS role,
  md5, seq, depth, substr(md5, 1, 1) <> '0' AS counted FROM variants""",
    "amplicons": "SELECT marker, sample, count(*) AS depth_amplicon FROM inserts GROUP BY marker, sample",
    "runs": "SELECT run, marker, sample, md5(seq) AS md5, seq, count(*) AS depth FROM inserts GROUP BY run, marker, sample, seq",
    "cdr3": f"""SELECT event_id, concat('I', u % 3, '_', CAST(floor(u / 3) AS INT)) AS sample, concat('I', u % 3) AS individual, 'TRB' AS marker,
  substr(translate(md5(concat('umi', user_id, '-', CAST(floor(value / 10) AS INT))), {_ACGT}), 1, 8) AS umi,
  CASE WHEN event_id % 17 = 0 THEN concat(substr(c, 1, 6), translate(substr(c, 7, 1), 'ACGT', 'CGTA'), substr(c, 8)) ELSE c END AS cdr3,
  concat('TRBV', length(event_type), CASE WHEN k % 7 = 0 THEN '*02' ELSE '*01' END) AS v, concat('TRBJ', k % 5) AS j FROM (
  SELECT *, {_bases("concat('cdr', key)", "CAST(15 + 3 * (key % 17) + CASE WHEN key % 11 = 0 THEN 1 ELSE 0 END AS INT)")} AS c FROM (
    SELECT event_id, user_id, value, event_type, CAST(user_id % 6 AS INT) AS u, CAST(translate(props, '{{}}"k: ', '') AS INT) AS k,
      CAST((user_id * 7 + length(event_type)) % 60 AS INT) AS key FROM events))""",
    "otus": """SELECT concat('OTU', l_partkey % 60) AS otu, concat('S', l_suppkey % 12) AS sample, count(*) AS depth FROM lineitem GROUP BY 1, 2""",
    "taxa": """SELECT concat('OTU', p_partkey % 60) AS otu, p_partkey AS hit, concat_ws(',', concat('k:K', p_partkey % 2), concat('p:P', p_partkey % 4), concat('c:C', p_partkey % 12), concat('o:O', p_partkey % 12),
  concat('f:F', p_partkey % 60), concat('g:G', p_partkey % 60, CASE WHEN p_size > 25 THEN 'x' ELSE '' END), concat('s:', 'G', p_partkey % 60, ' s', p_size % 3)) AS taxonomy FROM part""",
    "calls": f"""SELECT concat('file', o_custkey % 5) AS source, concat('chr', CAST(floor(o_custkey / 60) AS INT)) AS chrom, CAST(o_orderkey % 400 AS INT) + 1 AS pos, '.' AS id,
  substr('ACGT', CAST(o_orderkey % 400 % 4 AS INT) + 1, 1) AS ref, substr('CGTA', CAST(o_orderkey % 400 % 4 AS INT) + 1, CASE WHEN o_orderkey % 9 = 0 THEN 2 ELSE 1 END) AS alt,
  CASE WHEN o_orderstatus = 'F' THEN 'PASS' ELSE 'LOW' END AS filter, CAST(floor(o_totalprice) AS BIGINT) % 90 + 31 AS dp, CAST(floor(o_totalprice) AS BIGINT) % 31 AS ad, o_orderkey AS order_id FROM orders""",
    "genes": "SELECT concat('G', p_partkey) AS gene, concat('chr', CAST(floor(p_partkey / 80) AS INT)) AS chrom, CAST((p_partkey * 37) % 380 AS INT) + 1 AS start, CAST((p_partkey * 37) % 380 AS INT) + 1 + p_size AS stop, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand FROM part",
}


def _needed(names: tuple[str, ...]) -> list[str]:
    """The views and all before them that they may use."""
    wanted = set(names)
    for view in reversed(VIEWS):
        if view in wanted:
            wanted |= {v for v in VIEWS if v != view and f"FROM {v}" in VIEWS[view]}
    return [v for v in VIEWS if v in wanted]


def with_views(sql: str, *names: str) -> str:
    """``sql`` (a select, or further views ``name AS (...), ... SELECT``) below the named views."""
    views = ", ".join(f"{v} AS ({VIEWS[v]})" for v in _needed(names))
    joint = ", " if not sql.lstrip().upper().startswith("SELECT") else " "
    return f"WITH {views}{joint}{sql}" if views else (sql if joint == " " else f"WITH {sql}")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    used = [t for t in TABLES if any(f"FROM {t}" in VIEWS[v] for v in _needed((name,)))]
    tables = ", ".join(f"{t} AS (SELECT * FROM parquet.`{sf_dir}/{t}.parquet`)" for t in used)
    views = ", ".join(f"{v} AS ({VIEWS[v]})" for v in _needed((name,)))
    return spark.sql(f"WITH {tables}, {views} SELECT * FROM {name}")
