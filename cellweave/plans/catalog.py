"""All registered queries of the engine, on the test tables, with their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import sequences, stats
from ..operators import barcodes, intervals, molecules, quant, splicing, variants
from ..operators.partitioning import stored, tasks_for
from . import workflows
from .bindings import READS, reads, sequence, sequence_sql, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


# Barcodes ------------------------------------------------------------------------------------

COUNTS = f"WITH {READS}, counts AS (SELECT bc, count(DISTINCT umi) AS umi_count FROM reads GROUP BY bc), ranks AS (SELECT *, row_number() OVER (ORDER BY umi_count DESC, bc) AS rank FROM counts)"
TOTALS = ", totals AS (SELECT bc, umi_count, rank, sum(umi_count) OVER (ORDER BY rank)::BIGINT AS total FROM ranks WHERE rank <= 50000 AND umi_count >= 2)"


def _ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return barcodes.ranked(barcodes.umi_counts(reads(spark, sf_dir)))


@query(f"{COUNTS} SELECT * FROM ranks")
def bc_umi_rank(spark, sf_dir):
    return _ranks(spark, sf_dir)


@query("WITH counts AS (SELECT user_id AS bc, count(DISTINCT event_id % 97) AS umi_count FROM events WHERE event_type = 'view' GROUP BY user_id) SELECT *, row_number() OVER (ORDER BY umi_count DESC, bc) AS rank FROM counts")
def event_bc_rank(spark, sf_dir):
    perfect = table(spark, sf_dir, "events").where("event_type = 'view'").select(F.col("user_id").alias("bc"), (F.col("event_id") % 97).alias("umi"))
    return barcodes.ranked(barcodes.umi_counts(perfect))


@query(f"{COUNTS} SELECT bc, umi_count FROM counts ORDER BY umi_count DESC, bc LIMIT 100")
def top_n_cells(spark, sf_dir):
    return barcodes.umi_counts(reads(spark, sf_dir)).orderBy(F.desc("umi_count"), "bc").limit(100)


@query(f"{COUNTS}{TOTALS} SELECT * FROM totals")
def cumulative_umi(spark, sf_dir):
    return barcodes.cumulative(_ranks(spark, sf_dir))


@query(f"""{COUNTS}{TOTALS}, ends AS (SELECT min(rank) AS r0, max(rank) AS r1, min(total) AS t0, max(total) AS t1 FROM totals)
SELECT rank, total, round((rank - r0) / (r1 - r0), 9) AS x, round((total - t0) / (t1 - t0), 9) AS y, round((total - t0) / (t1 - t0) - (rank - r0) / (r1 - r0), 9) AS diff FROM totals, ends""")
def knee_curve(spark, sf_dir):
    curve = barcodes.difference_curve(barcodes.cumulative(_ranks(spark, sf_dir)))
    return curve.select("rank", "total", *(F.round(c, 9).alias(c) for c in ("x", "y", "diff")))


#: Step by step as the curve is walked: a top sets the bar one step below itself, a dip behind it lowers the bar to 0.
KNEE = f"""{COUNTS}{TOTALS}, c AS (SELECT rank - 1 AS i, total, count(*) OVER () AS n, min(total) OVER () AS t0, max(total) OVER () AS t1 FROM totals),
d AS (SELECT i, 1::DOUBLE / (n - 1) AS step, (total - t0) / (t1 - t0) - CASE WHEN i = n - 1 THEN 1 ELSE i * (1::DOUBLE / (n - 1)) END AS d FROM c),
m AS (SELECT *, lag(d) OVER w AS before, lead(d) OVER w AS after FROM d WINDOW w AS (ORDER BY i)),
k AS (SELECT *, coalesce(d >= before AND d >= after, FALSE) AS top, coalesce(d <= before AND d <= after AND NOT (d >= before AND d >= after), FALSE) AS dip FROM m),
l AS (SELECT i, d, step, max(i) FILTER (top) OVER w AS top, max(i) FILTER (dip) OVER w AS dip FROM k WINDOW w AS (ORDER BY i ROWS UNBOUNDED PRECEDING)),
knee AS (SELECT arg_min(top, l.i) + 1 AS cells FROM l LEFT JOIN (SELECT i, d AS height FROM d) h ON h.i = l.top WHERE d < CASE WHEN dip > top THEN 0 ELSE height - step END)"""


@query(f"{KNEE} SELECT ranks.* FROM ranks, knee WHERE rank <= cells")
def ref_barcodes_by_knee(spark, sf_dir):
    return barcodes.cells_by_knee(_ranks(spark, sf_dir))


@query(f"WITH {READS} SELECT bc, count(*) AS reads, count(DISTINCT gene) AS genes, count(DISTINCT trans) AS transcripts FROM reads GROUP BY bc")
def reads_per_cell(spark, sf_dir):
    return barcodes.contents(reads(spark, sf_dir), ["gene", "trans"]).select("bc", F.col("_rows").alias("reads"), F.col("gene").alias("genes"), F.col("trans").alias("transcripts"))


# Intervals -----------------------------------------------------------------------------------


@query(f"""WITH {READS}, marked AS (
  SELECT chrom, start, stop, CASE WHEN start <= max(stop) OVER (PARTITION BY chrom ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM reads
), numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY chrom ORDER BY start, stop ROWS UNBOUNDED PRECEDING) AS island FROM marked)
SELECT chrom, min(start) AS start, max(stop) AS stop FROM numbered GROUP BY chrom, island""")
def merge_regions(spark, sf_dir):
    return intervals.merge(reads(spark, sf_dir), bin_size=365)


@query(f"WITH {READS} SELECT bc, umi, trans, chrom, start, stop FROM reads WHERE chrom BETWEEN 10 AND 40 AND start < 2500 AND stop > 2000")
def reads_in_region(spark, sf_dir):
    rows = reads(spark, sf_dir).where("chrom between 10 and 40").where(intervals.overlaps("start", "stop", 2000, 2500))
    return rows.select("bc", "umi", "trans", "chrom", "start", "stop")


# Reads ---------------------------------------------------------------------------------------

FLAG = "(case when l_returnflag = 'R' then 256 else 0 end + case when l_linenumber = 7 then 2048 else 0 end + case when l_quantity < 3 then 4 else 0 end)"


@query(f"""WITH r AS (SELECT {FLAG} AS flag, l_linenumber = 6 AS sa FROM lineitem)
SELECT flag, sa, (flag & 4) > 0 OR (flag & 256) > 0 OR (flag & 2048) > 0 AS skip,
  CASE WHEN sa THEN 'chimeric' WHEN (flag & 2048) > 0 THEN 'non_primary' WHEN (flag & 260) > 0 THEN 'unmapped' ELSE 'proper' END AS tag, count(*) AS n
FROM r GROUP BY ALL""")
def read_flag_filter(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.expr(FLAG).alias("flag"), F.expr("l_linenumber = 6").alias("sa"))
    return rows.select("flag", "sa", *molecules.read_filter("flag", F.col("sa"))).groupBy("flag", "sa", "skip", "tag").agg(F.count("*").alias("n"))


@query(f"SELECT o_orderkey, {sequence_sql('o_orderkey', 14)} AS seq, translate(reverse({sequence_sql('o_orderkey', 14)}), 'ACGT', 'TGCA') AS rc FROM orders")
def revcomp_seq(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(sequence("o_orderkey", 14)).alias("seq"))
    return rows.withColumn("rc", sequences.revcomp("seq"))


SYNTHETIC = "case when o_orderkey % 7 = 0 then 'GATTACA' else '{a}' end || {bc} || {umi} || repeat('T', cast(8 + o_orderkey % 5 as int)) || 'ACGTACGT'"


def _synthetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = SYNTHETIC.format(a=sequences.ADAPTER, bc=sequence("o_custkey", 16), umi=sequence("o_orderkey", 12))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.expr(f"concat({sequence('o_orderkey + 5', 9)}, {text})").alias("seq"))


@query(f"""WITH s AS (SELECT o_orderkey, {sequence_sql('o_orderkey + 5', 9)} || {SYNTHETIC.format(a=sequences.ADAPTER, bc=sequence_sql('o_custkey', 16), umi=sequence_sql('o_orderkey', 12))} AS seq FROM orders),
p AS (SELECT *, instr(seq, '{sequences.ADAPTER}') AS pos FROM s), q AS (SELECT *, pos > 0 AND length(substr(seq, pos + 22, 28)) = 28 AS whole FROM p)
SELECT o_orderkey, CASE WHEN whole THEN substr(seq, pos + 22, 16) ELSE '' END AS bc, CASE WHEN whole THEN substr(seq, pos + 38, 12) ELSE '' END AS umi,
  CASE WHEN whole THEN substr(seq, pos + 22, 33) ELSE '' END AS bu, whole AND substr(seq, pos + 50, 10) = 'TTTTTTTTTT' AS is_perfect FROM q""")
def extract_bc_umi(spark, sf_dir):
    return _synthetic(spark, sf_dir).select("o_orderkey", *sequences.perfect_tag("seq"))


BROKEN = "CASE o_orderkey % 3 WHEN 1 THEN replace(seq, 'CTACACGACGC', 'CTACACGCGC') WHEN 2 THEN replace(seq, 'TCTTCCGATCT', 'TCTTCAGATCT') ELSE seq END"


def best_end_sql(query_: str, target: str, most: int) -> str:
    """The first end at which some substring of target is nearest to query; null beyond ``most`` edits."""
    cells = f"SELECT s + n - 1 AS e, levenshtein({query_}, substr({target}, s, n)) AS d FROM range(1, length({target}) + 1) AS a(s), range(length({query_}) - {most}, length({query_}) + {most} + 1) AS b(n) WHERE s + n - 1 <= length({target})"
    return f"(SELECT arg_min(e, d * 1000 + e) FROM ({cells}) WHERE d <= {most})"


@query(f"""WITH o AS (SELECT o_orderkey, {sequence_sql('o_orderkey + 5', 9)} || {SYNTHETIC.format(a=sequences.ADAPTER, bc=sequence_sql('o_custkey', 16), umi=sequence_sql('o_orderkey', 12))} AS seq FROM orders),
s AS (SELECT o_orderkey, {BROKEN} AS seq, instr({BROKEN}, '{sequences.ADAPTER}') > 0 AS exact FROM o),
e AS (SELECT *, CASE WHEN exact THEN instr(seq, '{sequences.ADAPTER}') + 21 ELSE {best_end_sql(f"'{sequences.ADAPTER}'", 'seq', 6)} END AS e FROM s),
q AS (SELECT *, coalesce(length(substr(seq, e + 1, 28)) = 28, FALSE) AS whole FROM e)
SELECT o_orderkey, CASE WHEN whole THEN substr(seq, e + 1, 16) ELSE '' END AS bc, CASE WHEN whole THEN substr(seq, e + 17, 12) ELSE '' END AS umi, CASE WHEN whole THEN substr(seq, e + 1, 33) ELSE '' END AS bu,
  exact AND whole AND substr(seq, e + 29, 10) = 'TTTTTTTTTT' AS is_perfect FROM q""")
def approx_adapter_extract(spark, sf_dir):
    """Every third adapter loses or changes a base; the search finds it again."""
    broken = F.expr("case o_orderkey % 3 when 1 then replace(seq, 'CTACACGACGC', 'CTACACGCGC') when 2 then replace(seq, 'TCTTCCGATCT', 'TCTTCAGATCT') else seq end")
    return sequences.tags(_synthetic(spark, sf_dir).withColumn("seq", broken)).drop("seq")


INFIX = "(SELECT min(levenshtein(q, substr(t, s, n))) FROM range(1, length(t) + 1) AS a(s), range(length(q) - 3, length(q) + 4) AS b(n) WHERE s + n - 1 <= length(t))"


@query(f"WITH p AS (SELECT c_custkey, {sequence_sql('c_custkey', 7)} AS q, {sequence_sql('c_custkey * 31 + 7', 15)} AS t FROM customer), d AS (SELECT *, {INFIX} AS d FROM p) SELECT c_custkey, q, t, CASE WHEN d <= 3 THEN d END::INT AS ed FROM d")
def infix_edit_distance(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.expr(sequence("c_custkey", 7)).alias("q"), F.expr(sequence("c_custkey * 31 + 7", 15)).alias("t"))
    return rows.withColumn("ed", sequences.infix_distance("q", "t", 3))


def _mutated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    refs = table(spark, sf_dir, "supplier").select(F.expr(sequence("s_suppkey", 16)).alias("ref"))
    whole = sequence("c_custkey % 100", 16)
    seen = table(spark, sf_dir, "customer").select("c_custkey", F.expr(f"concat(substr({whole}, 1, cast(c_custkey % 16 as int)), substr({sequence('c_custkey', 16)}, 1, cast(c_custkey % 4 as int)), substr({whole}, cast(1 + c_custkey % 16 + c_custkey % 4 as int)))").alias("bc"))
    return seen, refs


MUTATED = f"""WITH w AS (SELECT c_custkey, {sequence_sql('c_custkey % 100', 16)} AS w, {sequence_sql('c_custkey', 16)} AS o FROM customer),
seen AS (SELECT c_custkey, substr(w, 1, c_custkey % 16) || substr(o, 1, c_custkey % 4) || substr(w, 1 + c_custkey % 16 + c_custkey % 4) AS bc FROM w),
refs AS (SELECT DISTINCT {sequence_sql('s_suppkey', 16)} AS ref FROM supplier),
d AS (SELECT c_custkey, bc, ref, (SELECT min(levenshtein(bc, substr(ref, s, n))) FROM range(1, 6) AS a(s), range(12, 17) AS b(n) WHERE s + n - 1 <= 16) AS ed FROM seen, refs),
near AS (SELECT c_custkey, bc, ref, ed::INT AS ed, count(*) OVER (PARTITION BY c_custkey) AS n FROM (SELECT *, min(ed) OVER (PARTITION BY c_custkey) AS least FROM d) WHERE ed <= 2 AND ed = least)"""


def _nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen, refs = _mutated(spark, sf_dir)
    near = seen.join(barcodes.nearest(seen, refs), "bc")
    unique = near.groupBy("c_custkey", "bc").agg(F.count("*").alias("n"), F.min("ref").alias("ref"), F.min("ed").alias("ed"))
    return unique.where("n = 1").drop("n")


@query(f"{MUTATED} SELECT c_custkey, bc, ref, ed FROM near WHERE n = 1")
def assign_reference_bc(spark, sf_dir):
    return _nearest(spark, sf_dir)


@query(f"{MUTATED} SELECT ed, count(*) AS n FROM near WHERE n = 1 GROUP BY ed")
def edit_distance_histogram(spark, sf_dir):
    return _nearest(spark, sf_dir).groupBy("ed").agg(F.count("*").alias("n"))


@query(f"""{MUTATED}, r AS (SELECT *, bc || {sequence_sql('c_custkey', 12)} || 'TTTTT' AS bu FROM near), t AS (SELECT *, {best_end_sql('ref', 'bu', 2)} AS e FROM r WHERE ed > 0 OR bc <> ref),
u AS (SELECT c_custkey, ref, ed, substr(bu, e + 1, 12) AS tag FROM t WHERE length(substr(bu, e + 1, 12)) = 12)
SELECT c_custkey, ref AS cell, {sequence_sql('c_custkey', 12)} AS cell_umi, 0 AS ed FROM near WHERE bc = ref
UNION ALL SELECT c_custkey, min(ref), min(tag), min(ed) FROM u WHERE c_custkey NOT IN (SELECT c_custkey FROM near WHERE bc = ref) GROUP BY c_custkey HAVING count(*) = 1""")
def assign_with_recut(spark, sf_dir):
    seen, refs = _mutated(spark, sf_dir)
    tags = seen.withColumns({"umi": F.expr(sequence("c_custkey", 12)), "bu": F.concat("bc", F.expr(sequence("c_custkey", 12)), F.lit("TTTTT"))})
    return barcodes.assign(tags, refs).select("c_custkey", "cell", "cell_umi", "ed")


# Molecules -----------------------------------------------------------------------------------


@query(f"WITH {READS} SELECT bc, umi, count(*) AS n_reads, array_to_string(list_sort(list(line::VARCHAR)), ',') AS reads FROM reads GROUP BY bc, umi")
def molecule_reads(spark, sf_dir):
    rows = reads(spark, sf_dir).withColumn("line", F.col("line").cast("string"))
    return molecules.grouped(rows, ["bc", "umi"], "line").withColumn("reads", F.array_join("reads", ","))


SETS = "case when quantity > 40 then {a}(trans, gene || ':LARGE', gene || ':SMALL') when quantity > 20 then {a}(trans, gene || ':LARGE') else {a}(trans) end"


@query(f"""WITH {READS}, e AS (SELECT DISTINCT bc, gene, r, t FROM (SELECT bc, gene, r, unnest({SETS.format(a='list_value')}) AS t FROM (SELECT *, row_number() OVER () AS r FROM reads))),
n AS (SELECT bc, gene, count(*) AS n FROM reads GROUP BY bc, gene), c AS (SELECT bc, gene, t, count(*) AS k FROM e GROUP BY bc, gene, t)
SELECT n.bc, n.gene, coalesce(string_agg(t, ',' ORDER BY t), '') AS common FROM n LEFT JOIN c ON n.bc = c.bc AND n.gene = c.gene AND k = n GROUP BY n.bc, n.gene""")
def transcript_set_intersection(spark, sf_dir):
    rows = reads(spark, sf_dir).withColumn("sets", F.expr(SETS.format(a="array")))
    return molecules.common_set(rows, ["bc", "gene"], "sets").withColumn("common", F.array_join("common", ","))


TAG = "concat(substr({umi}, 1, 11), case when line = 5 then 'A' else substr({umi}, 12, 1) end)"


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads with tags of twelve letters, an error every fifth line."""
    rows = reads(spark, sf_dir).withColumn("_letters", F.expr(sequence("umi", 12)))  # used twice, so made once
    return rows.withColumns({"tag": F.expr(TAG.format(umi="_letters")), "sets": F.expr(SETS.format(a="array"))}).drop("_letters")


@query()
def umi_cluster(spark, sf_dir):
    """Molecules of each cell."""
    place = F.concat_ws(":", F.lpad(F.col("start").cast("string"), 6, "0"), F.lpad(F.col("chrom").cast("string"), 9, "0"), F.col("line").cast("string"))
    rows = _tagged(spark, sf_dir).select("bc", F.col("tag").alias("umi"), F.concat_ws(":", "umi", "line", "chrom").alias("qname"), F.col("sets").alias("trans"), (F.col("line") < 3).alias("is_perfect"), place.alias("pos"))
    return molecules.molecules(rows, ["bc"], dealt=True)


@query()
def candidate_merge(spark, sf_dir):
    """Candidate barcodes of five letters, taken in by richer ones that share a tag and a place."""
    rows = reads(spark, sf_dir).select(F.expr(sequence("bc % 700", 5)).alias("bc"), F.col("line").alias("umi"), (F.col("chrom") % 20).alias("chrom"), "start", "stop")
    ranks = barcodes.ranked(barcodes.umi_counts(rows.withColumn("umi", F.concat_ws(":", "umi", "chrom", "start"))))
    return barcodes.candidates_merged(rows, ranks, knee=60, length=5, most=1)


@query()
def umi_sketch_counts(spark, sf_dir):
    """About the number of different tags of a barcode, from sketches of three chunks; tests hold it against the exact count."""
    rows = reads(spark, sf_dir)
    chunks = [barcodes.umi_sketches(rows.where(F.col("chrom") % 3 == i)) for i in range(3)]
    return barcodes.merged_counts(chunks[0].unionByName(chunks[1]).unionByName(chunks[2]))


@query(f"""WITH {READS}, tags AS (SELECT bc, u, list_distinct(flatten(list(t))) AS t FROM (SELECT bc, {TAG.format(umi=sequence_sql("umi", 12))} AS u, {SETS.format(a='list_value')} AS t FROM reads) GROUP BY bc, u),
keys AS (SELECT bc, u, t, u AS k FROM tags UNION SELECT bc, u, t, substr(u, 1, i - 1) || substr(u, i + 1) FROM tags, range(1, 13) AS r(i))
SELECT DISTINCT x.bc, x.u AS a, y.u AS b FROM keys x JOIN keys y ON x.bc = y.bc AND x.k = y.k AND x.u < y.u WHERE list_has_any(x.t, y.t)""")
def umi_edges(spark, sf_dir):
    """Tags of a cell that may meet in the clustering."""
    each = _tagged(spark, sf_dir).select("bc", F.col("tag").alias("umi"), F.explode("sets").alias("t"))
    return molecules.near_tags(stored(each.groupBy("bc", "umi").agg(F.collect_set("t").alias("trans")), "tags"), ["bc"])


LISTS = f"WITH {READS}, m AS (SELECT bc, umi, list(struct_pack(l := line::VARCHAR, c := CASE WHEN quantity > 25 THEN 'FullLen' ELSE 'Partial' END, s := CASE WHEN hap = 'H1' THEN 'Y' ELSE 'N' END) ORDER BY line, quantity, hap) AS z FROM reads GROUP BY bc, umi)"


@query(f"{LISTS}, k AS (SELECT bc, umi, list_filter(z, lambda x: x.c = 'FullLen' AND x.s = 'Y') AS z FROM m) SELECT bc, umi, array_to_string(list_transform(z, lambda x: x.l), ',') AS names, len(z)::INT AS n FROM k WHERE len(z) > 0")
def category_splice_filter(spark, sf_dir):
    item = F.struct("line", "quantity", "hap", F.expr("if(quantity > 25, 'FullLen', 'Partial')").alias("c"), F.expr("if(hap = 'H1', 'Y', 'N')").alias("s"))
    rows = reads(spark, sf_dir).groupBy("bc", "umi").agg(F.array_sort(F.collect_list(item)).alias("z"))
    rows = rows.select("bc", "umi", F.transform("z", lambda x: x["line"].cast("string")).alias("names"), F.col("z.c").alias("cates"), F.col("z.s").alias("splices"))
    kept = molecules.keep_elements(rows, ["names", "cates", "splices"], "x.cates = 'FullLen' and x.splices = 'Y'")
    return kept.select("bc", "umi", F.array_join("names", ",").alias("names"), F.size("names").alias("n"))


EQUAL, MATCHES = "case when l_linenumber < 4 then concat(p_type, ',', p_brand) else 'NA' end", "concat(p_type, ' , ', p_brand, ',')"


@query(f"""WITH r AS (SELECT l_orderkey, l_linenumber, p_type, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber < 4 THEN p_type ELSE p_type || ';' || p_brand END AS trans, CASE WHEN l_linenumber < 4 THEN 'FullLen' ELSE 'Partial' END AS category FROM r""")
def compat_projection(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.select("l_orderkey", "l_linenumber", F.expr(EQUAL).alias("equal"), F.expr(MATCHES).alias("matches"))
    return rows.select("l_orderkey", "l_linenumber", *molecules.compatibility("equal", "matches")).withColumn("trans", F.array_join("trans", ";"))


@query(f"WITH {READS} SELECT CASE WHEN chrom % 11 = 0 THEN 'unassigned' ELSE 'chr' || (chrom % 25) END AS chrom, count(*) AS n FROM reads GROUP BY 1")
def split_by_chrom_counts(spark, sf_dir):
    name = F.expr("case when chrom % 11 = 0 then 'unassigned' else concat('chr', chrom % 25) end").alias("chrom")
    return reads(spark, sf_dir).groupBy(name).agg(F.count("*").alias("n"))


@query(f"WITH {READS} SELECT bc, umi, trans, start FROM reads WHERE chrom % 3 = 0 UNION ALL SELECT bc, umi, trans, start FROM reads WHERE chrom % 3 = 1 UNION ALL SELECT bc, umi, trans, start FROM reads WHERE chrom % 3 = 2")
def merge_chunks(spark, sf_dir):
    rows = reads(spark, sf_dir).select("chrom", "bc", "umi", "trans", "start")
    chunk = lambda i: rows.where(F.col("chrom") % 3 == i).drop("chrom")
    return chunk(0).unionByName(chunk(1)).unionByName(chunk(2))


PLACE = "l_orderkey * 8 + l_linenumber"


@query(f"""SELECT l_orderkey || CASE WHEN flag >= 2048 THEN '_r0x' || lower(hex(i)) ELSE '' END AS qname, CASE WHEN flag IN (2048, 2064) THEN flag - 2048 ELSE flag END AS flag, o
FROM (SELECT *, row_number() OVER (ORDER BY {PLACE}, o, l_quantity) - 1 AS i FROM (SELECT *, l_partkey AS o, (CASE WHEN l_linenumber > 1 THEN 2048 ELSE 0 END + CASE WHEN l_returnflag = 'R' THEN 16 ELSE 0 END + CASE WHEN l_quantity < 3 THEN 4 ELSE 0 END)::BIGINT AS flag FROM lineitem) WHERE (flag & 4) = 0)""")
def chimeric_rename(spark, sf_dir):
    flag = "cast(case when l_linenumber > 1 then 2048 else 0 end + case when l_returnflag = 'R' then 16 else 0 end + case when l_quantity < 3 then 4 else 0 end as long)"
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("qname"), F.expr(flag).alias("flag"), F.expr(PLACE).alias("place"), F.col("l_partkey").alias("o"), "l_quantity")
    return molecules.rename_chimeric(rows, ties=["o", "l_quantity"]).select("qname", "flag", "o")


HITS = {"rt": "nullif(l_linenumber % 4, 0)", "tso": "nullif(l_partkey % 3, 0)", "rt_back": "nullif(l_suppkey % 4, 0)", "tso_back": "nullif(l_orderkey % 2, 0)", "poly": "l_returnflag = 'R'", "poly_back": "l_linestatus = 'O'"}


@query(f"""WITH h AS (SELECT {', '.join(f'{v} AS {k}' for k, v in HITS.items())} FROM lineitem),
c AS (SELECT CASE WHEN (rt IS NOT NULL AND tso IS NOT NULL) OR (rt_back IS NOT NULL AND tso_back IS NOT NULL) THEN 'Proper'
  WHEN rt IS NOT NULL AND rt_back IS NOT NULL THEN CASE WHEN rt = rt_back OR (rt < rt_back AND poly_back) OR (rt > rt_back AND poly) THEN 'RT-RT' ELSE 'RT' END
  WHEN rt IS NOT NULL OR rt_back IS NOT NULL THEN 'RT' WHEN tso IS NOT NULL AND tso_back IS NOT NULL THEN 'TSO-TSO' WHEN tso IS NOT NULL OR tso_back IS NOT NULL THEN 'TSO' ELSE 'No-RT-TSO' END AS class FROM h)
SELECT class, count(*) AS n FROM c GROUP BY class""")
def artifact_class(spark, sf_dir):
    hits = table(spark, sf_dir, "lineitem").select(*(F.expr(v).alias(k) for k, v in HITS.items()))
    return hits.select(sequences.read_class(*HITS).alias("class")).groupBy("class").agg(F.count("*").alias("n"))


# Expression ----------------------------------------------------------------------------------


def _molecule_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads(spark, sf_dir).groupBy("bc", "umi", "gene", "cluster").agg(F.array_sort(F.collect_set("trans")).alias("trans"), F.min("hap").alias("hap"))


#: Rounds of expectation and maximisation for all genes and clusters side by side; each stops by itself, and the shares
#: before its last round spread its molecules.
EM_STEPS = """
names AS (SELECT gene, list_sort(list_distinct(list(trans))) AS names FROM reads GROUP BY gene),
sets AS (SELECT gene, cluster, names, list(struct_pack(n := n, m := list_transform(names, lambda t: list_contains(ts, t)::INT)) ORDER BY ts) AS sets, sum(n) AS total FROM (SELECT gene, cluster, ts, count(*) AS n FROM m GROUP BY ALL) JOIN names USING (gene) GROUP BY gene, cluster, names),
em AS (
  SELECT gene, cluster, 0 AS round, list_transform(names, lambda t: 1 / len(names)) AS share, list_transform(names, lambda t: 0::DOUBLE) AS prior, FALSE AS done FROM sets
  UNION ALL
  SELECT gene, cluster, round + 1, share, prior, list_sum(list_transform(range(1, len(share) + 1), lambda i: abs(share[i] - prior[i]))) < 1e-6 FROM (
    SELECT gene, cluster, round, share AS prior, list_transform(range(1, len(names) + 1), lambda t: list_sum(list_transform(sets, lambda s: s.n * s.m[t] * share[t] / list_sum(list_transform(range(1, len(names) + 1), lambda u: s.m[u] * share[u])))) / total) AS share
    FROM em JOIN sets USING (gene, cluster) WHERE NOT done AND round <= 10000)
),
shares AS (SELECT gene, cluster, unnest(names) AS trans, unnest(prior) AS share FROM (SELECT gene, cluster, arg_max(prior, round) AS prior FROM em GROUP BY gene, cluster) JOIN names USING (gene)),
spread AS (SELECT r, gene, cluster, hap, trans, share / sum(share) OVER (PARTITION BY r) AS part FROM (SELECT r, gene, cluster, hap, unnest(ts) AS trans FROM (SELECT *, row_number() OVER () AS r FROM m)) JOIN shares USING (gene, cluster, trans))"""
EM = f"""WITH RECURSIVE {READS}, m AS (SELECT bc, umi, gene, cluster, list_sort(list_distinct(list(trans))) AS ts, min(hap) AS hap FROM reads GROUP BY bc, umi, gene, cluster),{EM_STEPS}"""


@query(f"{EM} SELECT gene, cluster, trans, round(sum(part), 6) AS abundance FROM spread GROUP BY gene, cluster, trans HAVING sum(part) > 0")
def em_abundance(spark, sf_dir):
    return quant.abundance(_molecule_sets(spark, sf_dir)).withColumn("abundance", F.round("abundance", 6))


@query(f"{EM} SELECT gene, cluster, trans, hap, round(sum(part), 6) AS abundance FROM spread GROUP BY gene, cluster, trans, hap HAVING sum(part) > 0")
def em_abundance_hap(spark, sf_dir):
    return quant.abundance(_molecule_sets(spark, sf_dir), extra=["hap"]).withColumn("abundance", F.round("abundance", 6))


#: A read's allele is that of its name; molecules without a full-length read go, and reads that are not do not vote.
VOTED = f"""WITH RECURSIVE {READS}, named AS (SELECT *, umi || ':' || line || ':' || chrom AS q, quantity > 25 AS full_length FROM reads),
haps AS (SELECT q, min(hap) AS h FROM named WHERE hap <> 'none' GROUP BY q),
m AS (SELECT *, CASE WHEN one > two THEN 'H1' WHEN two > one THEN 'H2' ELSE 'none' END AS hap FROM (
  SELECT bc, umi, gene, cluster, list_sort(list_distinct(list(trans))) AS ts, count(*) FILTER (full_length AND h = 'H1') AS one, count(*) FILTER (full_length AND h = 'H2') AS two
  FROM named LEFT JOIN haps USING (q) GROUP BY bc, umi, gene, cluster HAVING count(*) FILTER (full_length) > 0)),{EM_STEPS.replace("hap, unnest(ts)", "hap, bc, unnest(ts)").replace("cluster, hap, trans, share /", "cluster, hap, bc, trans, share /")}"""


@query(f"{VOTED} SELECT gene, cluster, bc, hap, trans, round(sum(part), 6) AS abundance FROM spread GROUP BY ALL HAVING sum(part) > 0")
def allele_matrices(spark, sf_dir):
    """What the matrices by allele hold: reads filtered, then votes, then one fit for all alleles."""
    rows = reads(spark, sf_dir).withColumn("q", F.concat_ws(":", "umi", "line", "chrom"))
    lists = [F.collect_list(F.col("q")).alias("reads"), F.collect_list(F.when(F.col("quantity") > 25, "FullLen").otherwise("Partial")).alias("categories"), F.collect_list(F.lit("Y")).alias("splices")]
    found = rows.groupBy("bc", "umi", "gene").agg(F.collect_set("trans").alias("trans"), *lists).withColumn("genes", F.array("gene")).drop("gene")
    haps = rows.where("hap <> 'none'").groupBy(F.col("q").alias("qname")).agg(F.min("hap").alias("hap"))
    cells = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("bc"), F.col("c_mktsegment").alias("cluster")).distinct()
    made = workflows.quantify(found, cells, "x.categories = 'FullLen'", haps)
    return made.withColumn("abundance", F.round("abundance", 6))


VALUES = f"WITH {READS}, v AS (SELECT gene, cluster, bc, count(DISTINCT umi) AS value FROM reads GROUP BY gene, cluster, bc)"


def _values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads(spark, sf_dir).groupBy("gene", "cluster", "bc").agg(F.countDistinct("umi").alias("value"))


@query(f"{VALUES} SELECT dense_rank() OVER (ORDER BY gene) AS feature_idx, dense_rank() OVER (ORDER BY bc) AS cell_idx, gene, bc, value FROM v")
def sparse_matrix_coo(spark, sf_dir):
    return quant.sparse(_values(spark, sf_dir))


@query(f"""{VALUES}, s AS (SELECT gene, cluster, sum(value)::BIGINT AS total, count(DISTINCT CASE WHEN value > 0 THEN bc END) AS cells FROM v GROUP BY gene, cluster),
n AS (SELECT c_mktsegment AS cluster, count(*) AS n_cells FROM customer GROUP BY 1)
SELECT gene, s.cluster, total, round(1e6 * total / sum(total) OVER (PARTITION BY s.cluster), 6) AS cpm, round(cells / n_cells, 9) AS pct FROM s JOIN n USING (cluster)""")
def cluster_expression(spark, sf_dir):
    sizes = table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("cluster")).agg(F.count("*").alias("n_cells"))
    return quant.by_cluster(_values(spark, sf_dir), sizes).withColumns({"cpm": F.round("cpm", 6), "pct": F.round("pct", 9)})


@query("SELECT a.c AS cluster1, b.c AS cluster2 FROM (SELECT DISTINCT c_mktsegment AS c FROM customer) a JOIN (SELECT DISTINCT c_mktsegment AS c FROM customer) b ON a.c < b.c")
def cluster_pairs(spark, sf_dir):
    return splicing.cluster_pairs(table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("cluster")))


@query(f"""{VALUES}, common AS (SELECT gene FROM v WHERE value > 0 GROUP BY gene HAVING count(DISTINCT bc) >= 3)
SELECT bc, count(DISTINCT gene) AS n_features, sum(value)::BIGINT AS total, round(100.0 * sum(CASE WHEN gene LIKE 'Brand#1%' THEN value ELSE 0 END) / sum(value), 6) AS marked_pct
FROM v SEMI JOIN common USING (gene) GROUP BY bc HAVING count(DISTINCT gene) >= 5 AND 100.0 * sum(CASE WHEN gene LIKE 'Brand#1%' THEN value ELSE 0 END) / sum(value) < 60""")
def cell_qc_filter(spark, sf_dir):
    return quant.cell_qc(_values(spark, sf_dir), min_features=5, most_marked=60.0, marked="^Brand#1").withColumn("marked_pct", F.round("marked_pct", 6))


@query(f"{VALUES} SELECT gene, cluster, bc, value, round(ln(1 + 1e4 * value / sum(value) OVER (PARTITION BY bc)), 6) AS normalized FROM v")
def log_normalize(spark, sf_dir):
    return quant.log_normalized(_values(spark, sf_dir)).withColumn("normalized", F.round("normalized", 6))


# Splicing ------------------------------------------------------------------------------------

TCOUNTS = f"WITH {READS}, counts AS (SELECT cluster, gene, trans, count(*) AS value FROM reads GROUP BY ALL)"
PAIRS = """, pairs AS (SELECT a.c AS cluster1, b.c AS cluster2 FROM (SELECT DISTINCT cluster AS c FROM counts) a JOIN (SELECT DISTINCT cluster AS c FROM counts) b ON a.c < b.c),
wide AS (SELECT cluster1, cluster2, t.gene, t.trans, coalesce(x.value, 0) AS n1, coalesce(y.value, 0) AS n2 FROM (SELECT DISTINCT gene, trans FROM counts) t CROSS JOIN pairs
  LEFT JOIN counts x ON x.cluster = cluster1 AND x.trans = t.trans LEFT JOIN counts y ON y.cluster = cluster2 AND y.trans = t.trans),
kept AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY cluster1, cluster2, gene) AS k FROM wide WHERE n1 >= 10 OR n2 >= 10) WHERE k >= 2)"""


def chi2_sql(source: str, keys: str, a: str, b: str, digits: int = 6) -> str:
    return f"""SELECT {keys}, round(sum(pow(abs({a} - ea) - y, 2) / ea + pow(abs({b} - eb) - y, 2) / eb), {digits}) AS statistic, count(*) - 1 AS df, round(max(abs({a} / sa - {b} / sb)), 9) AS delta
FROM (SELECT *, CASE WHEN k = 2 THEN least(0.5, abs({a} - ea)) ELSE 0 END AS y FROM (SELECT *, sa * ({a} + {b}) / (sa + sb) AS ea, sb * ({a} + {b}) / (sa + sb) AS eb
  FROM (SELECT *, sum({a}) OVER (PARTITION BY {keys}) AS sa, sum({b}) OVER (PARTITION BY {keys}) AS sb, count(*) OVER (PARTITION BY {keys}) AS k FROM ({source})))) GROUP BY {keys}"""


def _trans_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads(spark, sf_dir).groupBy("cluster", "gene", "trans").agg(F.count("*").alias("value"))


@query(TCOUNTS + PAIRS + chi2_sql("SELECT cluster1, cluster2, gene, n1, n2 FROM kept", "cluster1, cluster2, gene", "n1", "n2"))
def diff_splice_stat(spark, sf_dir):
    rows = stats.chi2(splicing.pair_counts(_trans_counts(spark, sf_dir)), ["cluster1", "cluster2", "gene"], "trans", "n1", "n2")
    return rows.withColumns({"statistic": F.round("statistic", 6), "delta": F.round("delta", 9)})


def tested_sql(source: str, keys: str, scope: str, order: str) -> str:
    """keys, statistic, df, delta, p, fdr, significant of ``chi2_sql``; p by the series of the incomplete gamma function, 0 far out."""
    part = f"PARTITION BY {scope}" if scope else ""
    return f"""x AS ({source}), t AS (SELECT {keys}, df, any_value(statistic) AS statistic, any_value(delta) AS delta,
  CASE WHEN any_value(statistic) > 3000 THEN 0 ELSE greatest(0, 1 - sum(CASE WHEN statistic > 0 THEN exp(-statistic / 2 + (df / 2 + n) * ln(statistic / 2) - lgamma(df / 2 + n + 1)) ELSE 0 END)) END AS p
  FROM x, range(0, 4000) AS r(n) GROUP BY {keys}, df),
q AS (SELECT *, p * count(*) OVER ({part}) / row_number() OVER ({part} ORDER BY p, {order}) AS q FROM t),
f AS (SELECT {keys}, df, statistic, delta, p, least(1.0, min(q) OVER ({part} ORDER BY p, {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS fdr FROM q)"""


def _rounded(rows: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return rows.withColumns({c: F.round(c, digits) for c in names})


SPLICED = TCOUNTS + PAIRS + ", " + tested_sql(chi2_sql("SELECT cluster1, cluster2, gene, n1, n2 FROM kept", "cluster1, cluster2, gene", "n1", "n2", 15), "cluster1, cluster2, gene", "cluster1, cluster2", "gene")
SHOWN = "round(statistic, 4) AS statistic, df, round(delta, 6) AS delta, round(p, 6) AS p, round(fdr, 6) AS fdr, fdr <= 0.05 AND delta > 0.05 AS significant FROM f"


@query(f"{SPLICED} SELECT cluster1, cluster2, gene, {SHOWN}")
def diff_splice_significant(spark, sf_dir):
    return _rounded(_rounded(splicing.differential(_trans_counts(spark, sf_dir)), "delta", "p", "fdr"), "statistic", digits=4)


@query(f"""WITH {READS}, v AS (SELECT bc, umi, gene, count(*) FILTER (hap = 'H1') AS h1, count(*) FILTER (hap = 'H2') AS h2 FROM reads GROUP BY bc, umi, gene)
SELECT *, CASE WHEN h1 > h2 THEN 'H1' WHEN h2 > h1 THEN 'H2' ELSE 'none' END AS hap FROM v""")
def hap_majority_vote(spark, sf_dir):
    return splicing.majority(reads(spark, sf_dir), ["bc", "umi", "gene"])


CUBE = f"""WITH {READS}, m AS (SELECT bc, umi, cluster, gene, trans, CASE WHEN count(*) FILTER (hap = 'H1') > count(*) FILTER (hap = 'H2') THEN 'H1' WHEN count(*) FILTER (hap = 'H2') > count(*) FILTER (hap = 'H1') THEN 'H2' ELSE 'none' END AS hap FROM reads GROUP BY bc, umi, cluster, gene, trans),
cube AS (SELECT cluster, gene, trans, count(*) FILTER (hap = 'H1') AS h1, count(*) FILTER (hap = 'H2') AS h2, count(*) FILTER (hap = 'none') AS unphased, count(*) AS total FROM m GROUP BY cluster, gene, trans)"""


def _cube(spark: SparkSession, sf_dir: str, by_read: bool = False, keys: tuple[str, ...] = ("cluster", "gene", "trans")) -> DataFrame:
    rows = reads(spark, sf_dir)
    if not by_read:
        rows = splicing.majority(rows, ["bc", "umi", "cluster", "gene", "trans"]).drop("h1", "h2")
    return splicing.allele_counts(rows, list(keys))


@query(f"{CUBE} SELECT * FROM cube")
def hap_count_cube(spark, sf_dir):
    return _cube(spark, sf_dir)


@query(f"WITH {READS} SELECT cluster, gene, trans, count(*) FILTER (hap = 'H1') AS h1, count(*) FILTER (hap = 'H2') AS h2, count(*) FILTER (hap = 'none') AS unphased, count(*) AS total FROM reads GROUP BY cluster, gene, trans")
def hap_count_cube_reads(spark, sf_dir):
    return _cube(spark, sf_dir, by_read=True)


PHASED = """, p1 AS (SELECT * FROM (SELECT *, count(*) OVER w AS n, sum(h1 + h2) OVER w AS sp, sum(total) OVER w AS st FROM cube WINDOW w AS (PARTITION BY cluster, gene)) WHERE n >= 2),
p2 AS (SELECT * FROM p1 WHERE greatest(h1, h2) >= 5 AND (h1 + h2) / total >= 0.7),
p3 AS (SELECT cluster, gene, trans, h1, h2, unphased, total FROM (SELECT *, count(*) OVER w AS l, sum(h1 + h2) OVER w AS s FROM p2 WINDOW w AS (PARTITION BY cluster, gene)) WHERE l >= 2 AND sp / st >= 0.7 AND s >= 20)"""


@query(f"{CUBE}{PHASED} SELECT * FROM p3")
def phasing_cascade(spark, sf_dir):
    return splicing.phased(_cube(spark, sf_dir), ["cluster", "gene"])


@query(f"{CUBE}{PHASED} " + chi2_sql("SELECT cluster, gene, h1, h2 FROM p3", "cluster, gene", "h1", "h2"))
def allele_splice_stat(spark, sf_dir):
    rows = stats.chi2(splicing.phased(_cube(spark, sf_dir), ["cluster", "gene"]), ["cluster", "gene"], "trans", "h1", "h2")
    return rows.withColumns({"statistic": F.round("statistic", 6), "delta": F.round("delta", 9)})


ALLELES = f"{CUBE}{PHASED}, " + tested_sql(chi2_sql("SELECT cluster, gene, h1, h2 FROM p3", "cluster, gene", "h1", "h2", 15), "cluster, gene", "", "cluster, gene")


@query(f"{ALLELES} SELECT cluster, gene, {SHOWN}")
def allele_specific_splicing(spark, sf_dir):
    return _rounded(_rounded(splicing.allele_specific(_cube(spark, sf_dir)), "delta", "p", "fdr"), "statistic", digits=4)


LF = stats.ln_factorial_sql
FISHER = f"""f AS (SELECT *, {LF('a + b')} + {LF('c + d')} + {LF('a + c')} + {LF('b + d')} - {LF('a + b + c + d')} AS m FROM t),
e AS (SELECT f.*, exp(m - ({LF('k')} + {LF('a + b - k')} + {LF('a + c - k')} + {LF('d - a + k')})) AS p, exp(m - ({LF('a')} + {LF('b')} + {LF('c')} + {LF('d')})) AS p0
  FROM f, range(0, 100000) AS r(k) WHERE k BETWEEN greatest(0, a - d) AND least(a + b, a + c))"""
FOUR = f"{CUBE}, t AS (SELECT cluster, gene, trans, h1 AS a, h2 AS b, sum(h1) OVER w - h1 AS c, sum(h2) OVER w - h2 AS d FROM cube WINDOW w AS (PARTITION BY cluster, gene)), {FISHER}, p AS (SELECT cluster, gene, trans, least(1.0, sum(CASE WHEN p <= p0 * (1 + 1e-7) THEN p ELSE 0 END)) AS p FROM e GROUP BY cluster, gene, trans)"


@query(f"{FOUR} SELECT cluster, gene, trans, round(p, 6) AS p FROM p")
def fisher_exact_p(spark, sf_dir):
    rows = splicing.each_against_rest(_cube(spark, sf_dir), ["cluster", "gene"], left="h1", right="h2")
    return rows.select("cluster", "gene", "trans", F.round("p", 6).alias("p"))


@query(f"""{FOUR}, q AS (SELECT *, p * count(*) OVER (PARTITION BY cluster) / row_number() OVER (PARTITION BY cluster ORDER BY p, trans) AS q FROM p)
SELECT cluster, trans, round(least(1.0, min(q) OVER (PARTITION BY cluster ORDER BY p, trans ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 5) AS fdr FROM q""")
def bh_fdr(spark, sf_dir):
    rows = splicing.each_against_rest(_cube(spark, sf_dir), ["cluster", "gene"], left="h1", right="h2")
    return stats.bh(rows, "p", ["cluster"], ["trans"]).select("cluster", "trans", F.round("fdr", 5).alias("fdr"))


CHOSEN = ", ".join(f"{a} AS {b}" for a, b in (("n1", "a"), ("n2", "b"), ("sum(n1) OVER w - n1", "c"), ("sum(n2) OVER w - n2", "d")))
EACH = FISHER.replace("f AS", "fe AS").replace("FROM f,", "FROM fe,").replace("f.*", "fe.*").replace("FROM t)", "FROM te)")


@query(f"""{SPLICED}, te AS (SELECT cluster1, cluster2, gene, trans, n1, n2, {CHOSEN} FROM kept WINDOW w AS (PARTITION BY cluster1, cluster2, gene)), {EACH},
g AS (SELECT cluster1, cluster2, gene, trans, n1, n2, least(1.0, sum(CASE WHEN p <= p0 * (1 + 1e-7) THEN p ELSE 0 END)) AS p FROM e GROUP BY ALL)
SELECT g.cluster1, g.cluster2, g.gene, trans, n1, n2, round(fdr, 6) AS fdr, round(delta, 6) AS delta, round(g.p, 6) AS p FROM g JOIN f USING (cluster1, cluster2, gene) WHERE fdr <= 0.05 AND delta > 0.05 AND g.p <= 0.05""")
def diff_splice_transcripts(spark, sf_dir):
    found = splicing.significant_transcripts(_trans_counts(spark, sf_dir))
    return _rounded(found, "fdr", "delta", "p").select("cluster1", "cluster2", "gene", "trans", "n1", "n2", "fdr", "delta", "p")


GCUBE = CUBE + ", g AS (SELECT cluster, gene, sum(h1)::BIGINT AS h1, sum(h2)::BIGINT AS h2, sum(unphased)::BIGINT AS unphased, sum(total)::BIGINT AS total FROM cube GROUP BY cluster, gene)"


@query(f"{GCUBE} SELECT * FROM g WHERE total >= 20 AND (h1 + h2) / total >= 0.7")
def ase_eligibility(spark, sf_dir):
    return splicing.expression_eligible(_gene_cube(spark, sf_dir))


def _gene_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cube(spark, sf_dir).groupBy("cluster", "gene").agg(*(F.sum(c).alias(c) for c in ("h1", "h2", "unphased", "total")))


@query(f"""{GCUBE}, e AS (SELECT *, h1 + h2 AS n FROM g WHERE total >= 20 AND (h1 + h2) / total >= 0.7)
SELECT cluster, gene, round(least(1.0, sum(exp({LF('n')} - {LF('k')} - {LF('n - k')} - n * ln(2)))), 6) AS p FROM e, range(0, 100000) AS r(k) WHERE k BETWEEN greatest(h1, h2) AND n GROUP BY cluster, gene""")
def binomial_tail_p(spark, sf_dir):
    return splicing.allele_expression(_gene_cube(spark, sf_dir)).select("cluster", "gene", F.round("p", 6).alias("p"))


@query(f"""{GCUBE}, e AS (SELECT *, h1 + h2 AS n FROM g WHERE total >= 20 AND (h1 + h2) / total >= 0.7),
t AS (SELECT cluster, gene, any_value(h1) AS h1, any_value(h2) AS h2, any_value(unphased) AS unphased, any_value(total) AS total, least(1.0, sum(exp({LF('n')} - {LF('k')} - {LF('n - k')} - n * ln(2)))) AS p FROM e, range(0, 100000) AS r(k) WHERE k BETWEEN greatest(h1, h2) AND n GROUP BY cluster, gene),
q AS (SELECT *, p * count(*) OVER () / row_number() OVER (ORDER BY p, cluster, gene) AS q FROM t),
f AS (SELECT *, least(1.0, min(q) OVER (ORDER BY p, cluster, gene ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS fdr FROM q)
SELECT cluster, gene, h1, h2, unphased, total, round(p, 6) AS p, round(fdr, 6) AS fdr, round(h1 / (h1 + h2), 6) AS ratio1, fdr <= 0.05 AS significant FROM f""")
def ase_genes(spark, sf_dir):
    return _rounded(splicing.allele_expression(_gene_cube(spark, sf_dir)), "p", "fdr", "ratio1")


BULK = f"WITH {READS}, b AS (SELECT gene, count(*) FILTER (hap = 'H1') AS h1, count(*) FILTER (hap = 'H2') AS h2, count(*) FILTER (hap = 'none') AS unphased, count(*) AS total, count(DISTINCT trans) AS n_trans FROM (SELECT * REPLACE (trans || ':' || (chrom % 10) AS gene) FROM reads) GROUP BY gene)"


def _bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reads(spark, sf_dir).withColumn("gene", F.expr("concat(trans, ':', chrom % 10)"))
    return splicing.allele_counts(rows, ["gene"]).join(rows.groupBy("gene").agg(F.countDistinct("trans").alias("n_trans")), "gene")


@query(f"{BULK} SELECT * FROM b WHERE h1 + h2 >= 20 AND greatest(h1, h2) / (h1 + h2) >= 0.8 AND (h1 + h2) / total >= 0.8")
def bulk_ae_genes(spark, sf_dir):
    return splicing.bulk_allele_expression(_bulk(spark, sf_dir))


LABELLED = f"""WITH {READS}, cube AS (SELECT cluster AS sample, gene || ':' || (chrom % 4) AS gene, trans, count(*) FILTER (hap = 'H1') AS h1, count(*) FILTER (hap = 'H2') AS h2, count(*) AS total FROM reads GROUP BY ALL),
a AS (SELECT *, greatest(h1, h2) >= 10 AND (h1 + h2) / total >= 0.8 AS passed FROM cube),
l AS (SELECT *, CASE WHEN count(*) OVER w < 2 OR sum(total) OVER w < 20 THEN 'LowExp' WHEN sum(h1 + h2) OVER w / sum(total) OVER w < 0.8 THEN 'Unphased' WHEN count(*) FILTER (passed) OVER w < 2 THEN 'NoSplice' END AS label FROM a WINDOW w AS (PARTITION BY sample, gene)),
""" + tested_sql(chi2_sql("SELECT sample, gene, h1, h2 FROM l WHERE label IS NULL AND passed", "sample, gene", "h1", "h2", 15), "sample, gene", "", "sample, gene")
LABELLED_FISHER = FISHER.replace("f AS", "fe AS").replace("FROM f,", "FROM fe,").replace("f.*", "fe.*").replace("FROM t)", "FROM te)")


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reads(spark, sf_dir).withColumnRenamed("cluster", "sample").withColumn("gene", F.expr("concat(gene, ':', chrom % 4)"))
    return splicing.allele_counts(rows, ["sample", "gene", "trans"])


@query(f"""{LABELLED} SELECT sample, gene, round(statistic, 4) AS statistic, df, round(delta, 6) AS delta, round(p, 6) AS p, round(fdr, 6) AS fdr, CASE WHEN fdr <= 0.05 AND delta >= 0.05 THEN 'True' ELSE 'False' END AS label FROM f
UNION ALL SELECT DISTINCT sample, gene, NULL, NULL, NULL, NULL, NULL, label FROM l WHERE label IS NOT NULL""")
def bulk_labels(spark, sf_dir):
    return _rounded(_rounded(splicing.bulk_genes(_samples(spark, sf_dir), ["sample", "gene"]), "delta", "p", "fdr"), "statistic", digits=4)


@query(f"""{LABELLED}, s AS (SELECT l.*, fdr FROM l JOIN f USING (sample, gene) WHERE label IS NULL AND passed AND fdr <= 0.05 AND f.delta >= 0.05),
te AS (SELECT sample, gene, trans, fdr, h1, h2, h1 / sum(h1) OVER w AS ratio1, h2 / sum(h2) OVER w AS ratio2, h1 AS a, h2 AS b, sum(h1) OVER w - h1 AS c, sum(h2) OVER w - h2 AS d FROM s WINDOW w AS (PARTITION BY sample, gene)), {LABELLED_FISHER},
g AS (SELECT sample, gene, trans, h1, h2, ratio1, ratio2, fdr, least(1.0, sum(CASE WHEN p <= p0 * (1 + 1e-7) THEN p ELSE 0 END)) AS p FROM e GROUP BY ALL)
SELECT sample, gene, trans, h1, h2, round(p, 6) AS p, round(ratio1, 6) AS ratio1, round(ratio2, 6) AS ratio2, CASE WHEN ratio1 > ratio2 THEN 'H1' ELSE 'H2' END AS hap, round(fdr, 6) AS fdr FROM g WHERE abs(ratio1 - ratio2) >= 0.05 AND p <= 0.05""")
def bulk_transcripts(spark, sf_dir):
    return _rounded(splicing.bulk_significant(_samples(spark, sf_dir), ["sample", "gene"]), "p", "ratio1", "ratio2", "fdr")


# Variants ------------------------------------------------------------------------------------

HULL = "SELECT 'G' || (p_partkey // 40) AS gene, arg_max(p_size % 5, p_partkey) AS chrom, arg_max(CASE WHEN p_brand LIKE '%1' THEN '+' ELSE '-' END, p_partkey) AS strand, min(p_partkey * 100)::BIGINT AS start, max(p_partkey * 100 + p_size)::BIGINT AS stop FROM part GROUP BY 1"


@query(HULL)
def gene_coord_hull(spark, sf_dir):
    return _hulls(spark, sf_dir)


def _hulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select(F.expr("concat('G', floor(p_partkey / 40))").alias("gene"), F.expr("p_size % 5").alias("chrom"), F.expr("if(p_brand like '%1', '+', '-')").alias("strand"), F.expr("p_partkey * 100").alias("start"), F.expr("p_partkey * 100 + p_size").alias("stop"), F.col("p_partkey").alias("line"))
    return variants.gene_hull(rows, more=["strand"], last="line")


GENES = "genes AS (SELECT p_partkey AS gene, p_size % 5 AS chrom, p_partkey * 1000 AS start, p_partkey * 1000 + p_size * 20 AS stop, CASE WHEN p_brand LIKE '%1' THEN '+' ELSE '-' END AS strand FROM part)"
SNPS = "snps AS (SELECT o_orderkey AS snp, o_orderkey % 5 AS chrom, o_orderkey * 113 AS pos, CASE o_orderkey % 3 WHEN 0 THEN 'H1' WHEN 1 THEN 'H2' END AS hap FROM orders)"


def _genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("gene"), F.expr("cast(p_size % 5 as long)").alias("chrom"), F.expr("p_partkey * 1000").alias("start"), F.expr("p_partkey * 1000 + p_size * 20").alias("stop"), F.expr("if(p_brand like '%1', '+', '-')").alias("strand"))


@query(f"WITH {GENES}, {SNPS} SELECT snp, gene, pos, hap FROM snps JOIN genes USING (chrom) WHERE hap IS NOT NULL AND pos BETWEEN start - CASE strand WHEN '+' THEN 500 ELSE 0 END AND stop + CASE strand WHEN '-' THEN 500 ELSE 0 END")
def snp_in_gene_range(spark, sf_dir):
    call = F.expr("case o_orderkey % 3 when 0 then '1|0' when 1 then '0|1' else '1|1' end")
    snps = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("snp"), F.expr("o_orderkey % 5").alias("chrom"), F.expr("o_orderkey * 113").alias("pos"), variants.genotype(call).alias("hap")).where("hap is not null")
    return variants.snps_in_genes(snps, _genes(spark, sf_dir)).select("snp", "gene", "pos", "hap")


CATALOG = "catalog AS (SELECT s_suppkey AS snp, s_suppkey % 5 AS chrom, s_suppkey * 20000 AS pos, 'G' || (s_suppkey % 25) || ', G' || (s_suppkey * 5) AS mapped FROM supplier)"


@query(f"WITH genes AS ({HULL}), {CATALOG} SELECT gene, snp, pos FROM genes JOIN catalog ON genes.chrom = catalog.chrom AND pos BETWEEN start - 1000000 AND stop + 1000000 AND contains(mapped, gene)")
def gwas_range_like(spark, sf_dir):
    catalog = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("snp"), F.expr("cast(s_suppkey % 5 as int)").alias("chrom"), F.expr("s_suppkey * 20000").alias("pos"), F.expr("concat('G', s_suppkey % 25, ', G', s_suppkey * 5)").alias("mapped"))
    return variants.catalog_near(_hulls(spark, sf_dir), catalog).select("gene", "snp", "pos")


LD = "ld AS (SELECT l_partkey AS snp_a, (l_partkey + l_suppkey) % 2000 AS snp_b, l_discount * 10 AS r2 FROM lineitem)"


def _ld(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("snp_a"), F.expr("(l_partkey + l_suppkey) % 2000").alias("snp_b"), F.expr("l_discount * 10").alias("r2"))


@query(f"WITH {LD}, b AS (SELECT snp_a AS donor, snp_b AS listed FROM ld WHERE r2 > 0.8 UNION SELECT snp_b, snp_a FROM ld WHERE r2 > 0.8) SELECT * FROM b WHERE donor IN (SELECT p_partkey FROM part WHERE p_size <= 10) AND listed IN (SELECT p_partkey FROM part WHERE p_size > 30)")
def ld_symmetric_pairs(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("snp"), "p_size")
    return variants.linked(parts.where("p_size <= 10"), parts.where("p_size > 30"), _ld(spark, sf_dir))


@query(f"""WITH {LD}, own AS (SELECT p_brand AS gene, p_partkey AS snp FROM part), m AS (SELECT least(snp_a, snp_b) AS snp_a, greatest(snp_a, snp_b) AS snp_b, max(r2) AS r2 FROM ld WHERE r2 > 0 AND snp_a <> snp_b GROUP BY 1, 2)
SELECT x.gene, snp_a, snp_b, r2 FROM m JOIN own x ON snp_a = x.snp JOIN own y ON snp_b = y.snp AND x.gene = y.gene UNION ALL SELECT gene, snp, snp, 1.0 FROM own""")
def ld_max_matrix(spark, sf_dir):
    return variants.linkage_matrix(table(spark, sf_dir, "part").select(F.col("p_brand").alias("gene"), F.col("p_partkey").alias("snp")), _ld(spark, sf_dir))


LISTED = "concat('rs', o_custkey, case o_orderkey % 3 when 0 then ' x ' when 1 then '-' else ', ' end, 'rs', o_orderkey)"


@query(f"SELECT o_orderkey, unnest(list_value('rs' || o_custkey, 'rs' || o_orderkey)) AS snp FROM orders")
def snp_list_explode(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(LISTED).alias("snps"))
    return variants.snp_list(rows).select("o_orderkey", "snp")


PARENTS = ["5-LOW", "2-HIGH", "1-URGENT"]
TRAITS = "t AS (SELECT o_custkey AS snp, o_orderstatus AS trait, o_orderpriority AS parent, o_totalprice AS p FROM orders)"


@query(f"""WITH {TRAITS}, b AS (SELECT snp, trait, parent, min(p) AS p FROM t GROUP BY ALL),
o AS (SELECT *, CASE parent WHEN '5-LOW' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '1-URGENT' THEN 3 ELSE 1073741824 END AS place FROM b)
SELECT snp, (list(trait ORDER BY place, p, trait))[1] AS leading, count(DISTINCT trait) AS n_traits, min(p) AS least_p FROM o GROUP BY snp""")
def leading_trait(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("snp"), F.col("o_orderstatus").alias("trait"), F.col("o_orderpriority").alias("parent"), F.col("o_totalprice").alias("p"))
    return variants.leading(rows, ["snp"], order=PARENTS)


@query("SELECT o_custkey AS gene, bool_or(o_orderstatus = 'F') AS F, bool_or(o_orderstatus = 'O') AS O, bool_or(o_orderstatus = 'P') AS P FROM orders GROUP BY o_custkey")
def trait_pivot(spark, sf_dir):
    return variants.trait_matrix(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("gene"), F.col("o_orderstatus").alias("trait")), "gene", "trait", ["F", "O", "P"])


# More of the same operators --------------------------------------------------------------------


@query(f"WITH {READS}, spans AS (SELECT trans, min(start) AS start, max(stop) AS stop, chrom FROM reads GROUP BY trans, chrom), m AS (SELECT bc, gene, list_sort(list_distinct(list(trans))) AS ts FROM reads GROUP BY bc, gene) SELECT bc, gene, array_to_string(ts, ',') AS ts FROM m WHERE EXISTS (SELECT 1 FROM spans WHERE chrom = 7 AND start <= 2600 AND stop >= 2001 AND list_contains(ts, trans))")
def transcripts_in_region(spark, sf_dir):
    rows = reads(spark, sf_dir)
    spans = rows.groupBy("trans", "chrom").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    sets = rows.groupBy("bc", "gene").agg(F.array_sort(F.collect_set("trans")).alias("ts"))
    return molecules.in_region(sets, spans, 7, 2000, 2600, trans="ts").withColumn("ts", F.array_join("ts", ","))


@query(f"{MUTATED} SELECT CASE WHEN c_custkey % 2 = 0 THEN 'perfect' ELSE 'imperfect' END AS tag, CASE WHEN ed = 0 THEN 'exact' ELSE 'corrected' END AS match, count(*) AS n FROM near WHERE n = 1 GROUP BY ALL")
def match_summary(spark, sf_dir):
    return molecules.match_summary(_nearest(spark, sf_dir).selectExpr("c_custkey % 2 = 0 as perfect", "ed = 0 as exact"), "perfect", "exact")


@query(f"{MUTATED} SELECT c_custkey, bc FROM seen WHERE c_custkey NOT IN (SELECT c_custkey FROM near WHERE n = 1)")
def unassigned_barcodes(spark, sf_dir):
    return _mutated(spark, sf_dir)[0].join(_nearest(spark, sf_dir), "c_custkey", "left_anti")


@query("SELECT c_custkey AS bc FROM customer WHERE c_mktsegment = 'BUILDING' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def cells_in_both(spark, sf_dir):
    left = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("bc"))
    return left.intersect(table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("bc")))


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(f"{VALUES} SELECT gene, " + ", ".join(f"coalesce(sum(value) FILTER (cluster = '{c}'), 0)::BIGINT AS {c}" for c in SEGMENTS) + " FROM v GROUP BY gene")
def cluster_matrix_wide(spark, sf_dir):
    return _values(spark, sf_dir).groupBy("gene").pivot("cluster", SEGMENTS).agg(F.sum("value")).na.fill(0)


@query("SELECT o_custkey AS gene, array_to_string(list_sort(list_distinct(list(o_orderstatus))), ',') AS traits, array_to_string(list_sort(list_distinct(list(o_orderpriority))), ',') AS parents FROM orders WHERE o_orderpriority IN ('5-LOW', '2-HIGH', '1-URGENT') GROUP BY o_custkey")
def gene_traits(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").where(F.col("o_orderpriority").isin(PARENTS))
    united = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return rows.groupBy(F.col("o_custkey").alias("gene")).agg(united("o_orderstatus").alias("traits"), united("o_orderpriority").alias("parents"))


@query("WITH k AS (SELECT p_partkey % 5 AS chrom, p_partkey * 7 AS pos, min('rs' || p_partkey) AS rsid FROM part GROUP BY 1, 2), s AS (SELECT o_orderkey, o_orderkey % 5 AS chrom, o_orderkey AS pos, CASE WHEN o_orderkey % 3 = 0 THEN 'own' || o_orderkey END AS snp FROM orders) SELECT o_orderkey, s.chrom, s.pos, coalesce(snp, rsid) AS snp FROM s LEFT JOIN k ON s.chrom = k.chrom AND s.pos = k.pos")
def snp_named_by_position(spark, sf_dir):
    known = table(spark, sf_dir, "part").select(F.expr("p_partkey % 5").alias("chrom"), F.expr("p_partkey * 7").alias("pos"), F.expr("concat('rs', p_partkey)").alias("rsid"))
    snps = table(spark, sf_dir, "orders").select("o_orderkey", F.expr("o_orderkey % 5").alias("chrom"), F.col("o_orderkey").alias("pos"), F.expr("if(o_orderkey % 3 = 0, concat('own', o_orderkey), null)").alias("snp"))
    return variants.named_by_position(snps, known)


@query("WITH d AS (SELECT s_suppkey % 5 AS chrom, s_suppkey * 1700 AS pos FROM supplier), l AS (SELECT o_orderkey AS snp, o_orderkey % 5 AS chrom, o_orderkey * 13 AS pos FROM orders) SELECT * FROM l WHERE EXISTS (SELECT 1 FROM d WHERE d.chrom = l.chrom AND abs(d.pos - l.pos) <= 250)")
def listed_near_donor(spark, sf_dir):
    donors = table(spark, sf_dir, "supplier").select(F.expr("s_suppkey % 5").alias("chrom"), F.expr("s_suppkey * 1700").alias("pos"))
    listed = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("snp"), F.expr("o_orderkey % 5").alias("chrom"), F.expr("o_orderkey * 13").alias("pos"))
    return variants.near_any(listed, donors, 250)


@query(f"WITH {READS}, m AS (SELECT bc, umi, gene, count(DISTINCT trans) AS k, min(trans) AS trans FROM reads GROUP BY bc, umi, gene) SELECT trans, count(*) AS n FROM m WHERE k = 1 GROUP BY trans")
def unique_transcript_counts(spark, sf_dir):
    return _molecule_sets(spark, sf_dir).where(F.size("trans") == 1).groupBy(F.col("trans")[0].alias("trans")).agg(F.count("*").alias("n"))


@query(f"{SPLICED} SELECT cluster1, cluster2, gene, {SHOWN} WHERE gene IN (SELECT p_brand FROM part WHERE p_size > 45)")
def genes_of_interest(spark, sf_dir):
    """Picked after the false discovery rate is found over all genes."""
    wanted = table(spark, sf_dir, "part").where("p_size > 45").select(F.col("p_brand").alias("gene")).distinct()
    found = splicing.differential(_trans_counts(spark, sf_dir)).join(wanted, "gene", "left_semi")
    return _rounded(_rounded(found, "delta", "p", "fdr"), "statistic", digits=4)


@query(f"""WITH {READS}, d AS (SELECT DISTINCT cluster, gene, umi FROM reads), n AS (SELECT cluster, gene, count(*) AS n FROM d GROUP BY ALL), b AS (SELECT x.gene, x.cluster AS cluster1, y.cluster AS cluster2, count(*) AS k FROM d x JOIN d y ON x.gene = y.gene AND x.umi = y.umi AND x.cluster < y.cluster GROUP BY ALL)
SELECT x.gene, x.cluster AS cluster1, y.cluster AS cluster2, x.n + y.n - coalesce(k, 0) AS n FROM n x JOIN n y ON x.gene = y.gene AND x.cluster < y.cluster LEFT JOIN b ON b.gene = x.gene AND cluster1 = x.cluster AND cluster2 = y.cluster""")
def merged_umi_counts(spark, sf_dir):
    """Tags of two clusters together, for every gene: both counts less what they share; no set is gathered."""
    rows = reads(spark, sf_dir).select("cluster", "gene", "umi")
    tags = rows.repartition(tasks_for(table(spark, sf_dir, "lineitem")), "gene", "umi").distinct()
    sizes = tags.groupBy("gene", "cluster").agg(F.count("*").alias("n"))
    two = lambda rows, *more: rows.select("gene", F.col("cluster").alias("cluster2"), *more)
    one = lambda rows, *more: rows.select("gene", F.col("cluster").alias("cluster1"), *more)
    keys = ["gene", "cluster1", "cluster2"]
    shared = one(tags, "umi").join(two(tags, "umi"), ["gene", "umi"]).where("cluster1 < cluster2").groupBy(*keys).agg(F.count("*").alias("k"))
    pairs = one(sizes, F.col("n").alias("n1")).join(two(sizes, F.col("n").alias("n2")), "gene").where("cluster1 < cluster2")
    return pairs.join(shared, keys, "left").select(*keys, (F.col("n1") + F.col("n2") - F.coalesce("k", F.lit(0))).alias("n"))
