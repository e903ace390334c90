"""DuckDB SQL equivalent to each registered query (the correctness oracle).

The tables named here are the driver's pre-registered views. ``RAW`` is the
projection of lineitem into raw intervals; ``CONV`` converts it the way the
coverage table is defined (names without 'chr', 1-based starts, NaN -> NULL,
sample id = file name before its first dot).
"""

from __future__ import annotations

from covtab.operators.validate import CHECKS

AUTOSOME_LIST = ", ".join(f"'{i}'" for i in range(1, 23))

RAW = """
raw AS (
  SELECT concat('study_', l_suppkey % 3) AS study_name,
         concat('grp_', l_suppkey % 2) AS qtl_group,
         concat('/cov/study_', l_suppkey % 3, '/grp_', l_suppkey % 2, '/bigwig/S', l_suppkey % 10,
                '.rep', l_linenumber % 2,
                CASE WHEN l_linenumber % 2 = 0 THEN '.bw' ELSE '.bigwig' END) AS file_path,
         CASE WHEN l_partkey % 26 = 0 THEN 'chrX' WHEN l_partkey % 26 = 23 THEN 'chrY'
              WHEN l_partkey % 26 = 24 THEN 'chrM' WHEN l_partkey % 26 = 25 THEN 'GL000219.1'
              ELSE concat(CASE WHEN l_linenumber % 2 = 0 THEN 'chr' ELSE '' END, l_partkey % 26) END AS chrom,
         CAST((l_orderkey * 97 + l_linenumber * 13) % 50000000 AS INTEGER) AS start0,
         CAST((l_orderkey * 97 + l_linenumber * 13) % 50000000 AS INTEGER)
           + CAST(l_quantity AS INTEGER) - 1 AS end0,
         CASE WHEN l_partkey % 97 = 0 THEN CAST('NaN' AS DOUBLE) ELSE l_extendedprice END AS score
  FROM lineitem
)"""

CONV = """
conv AS (
  SELECT study_name, qtl_group, file_path,
         replace(chrom, 'chr', '') AS seqnames,
         CAST(start0 + 1 AS INTEGER) AS start,
         CAST(end0 AS INTEGER) AS "end",
         '*' AS strand,
         CASE WHEN isnan(score) THEN NULL ELSE score END AS score,
         split_part(regexp_extract(file_path, '[^/]*$'), '.', 1) AS sample_id
  FROM raw
)"""

BASE = f"WITH {RAW},{CONV}"

COVERAGE_COLS = 'study_name, qtl_group, seqnames, start, "end", strand, score, sample_id'


def _converted(where: str) -> str:
    return f"""converted AS (
  SELECT {COVERAGE_COLS}, file_path FROM conv WHERE {where} AND "end" >= start
)"""


AUTOSOMES_WHERE = f"seqnames IN ({AUTOSOME_LIST})"
REGION_22_WHERE = "seqnames = '22' AND \"end\" >= 20000 AND start <= 60000"

COUNT_RANK = "coalesce(TRY_CAST(seqnames AS INTEGER), if(seqnames = 'X', 23, 1000))"

ORACLE: dict[str, str] = {}

ORACLE["convert_autosomes"] = f"""{BASE}, {_converted(AUTOSOMES_WHERE)}
SELECT {COVERAGE_COLS} FROM converted"""

ORACLE["convert_region"] = f"""{BASE}, {_converted(REGION_22_WHERE)}
SELECT {COVERAGE_COLS} FROM converted"""

ORACLE["convert_chrom_x"] = f"""{BASE}, {_converted("seqnames = 'X'")}
SELECT {COVERAGE_COLS} FROM converted"""

ORACLE["chrom_counts"] = f"""{BASE}, {_converted(AUTOSOMES_WHERE)}
SELECT study_name, qtl_group, seqnames, CAST(count(*) AS BIGINT) AS n, {COUNT_RANK} AS chrom_rank
FROM converted GROUP BY study_name, qtl_group, seqnames"""

ORACLE["rows_per_file"] = f"""{BASE}, {_converted(AUTOSOMES_WHERE)},
files AS (SELECT DISTINCT file_path, study_name, qtl_group FROM raw),
counts AS (SELECT file_path, count(*) AS n FROM converted GROUP BY file_path)
SELECT f.file_path, f.study_name, f.qtl_group, CAST(coalesce(c.n, 0) AS BIGINT) AS rows_written
FROM files f LEFT JOIN counts c ON f.file_path = c.file_path"""

ORACLE["no_data_files"] = f"""{BASE}, {_converted("seqnames = '22' AND start <= 3000")},
files AS (SELECT DISTINCT file_path, study_name, qtl_group FROM raw),
counts AS (SELECT file_path, count(*) AS n FROM converted GROUP BY file_path)
SELECT f.file_path, f.study_name, f.qtl_group, CAST(0 AS BIGINT) AS rows_written
FROM files f LEFT JOIN counts c ON f.file_path = c.file_path
WHERE c.n IS NULL"""

ORACLE["validate_summary"] = f"""{BASE}, {_converted(AUTOSOMES_WHERE)}
SELECT study_name, qtl_group,
       CAST(count(*) AS BIGINT) AS row_count,
       CAST(count_if(seqnames IS NULL OR start IS NULL OR "end" IS NULL OR strand IS NULL
                     OR score IS NULL OR sample_id IS NULL) AS BIGINT) AS null_rows,
       CAST(count_if(start < 1 OR "end" < start) AS BIGINT) AS bad_intervals,
       CAST(count_if(strand <> '*') AS BIGINT) AS bad_strand,
       CAST(count_if(seqnames <> '22') AS BIGINT) AS off_chrom,
       CAST(count_if("end" < 20000) AS BIGINT) AS end_before_start_bound,
       CAST(count_if(start > 60000) AS BIGINT) AS start_after_end_bound,
       CAST(count(DISTINCT sample_id) AS BIGINT) AS n_samples
FROM converted GROUP BY study_name, qtl_group"""


def _na_branch(col: str, isna: str) -> str:
    return (f"SELECT study_name, qtl_group, '{col}' AS column_name, "
            f"CAST(count_if({isna}) AS BIGINT) AS na_count, CAST(count(*) AS BIGINT) AS total_rows "
            f"FROM converted GROUP BY study_name, qtl_group")


ORACLE["null_report"] = f"""{BASE}, {_converted(AUTOSOMES_WHERE)},
na AS (
  {_na_branch('seqnames', 'seqnames IS NULL')}
  UNION ALL {_na_branch('start', 'start IS NULL')}
  UNION ALL {_na_branch('end', '"end" IS NULL')}
  UNION ALL {_na_branch('strand', 'strand IS NULL')}
  UNION ALL {_na_branch('score', 'score IS NULL OR isnan(score)')}
  UNION ALL {_na_branch('sample_id', 'sample_id IS NULL')}
)
SELECT study_name, qtl_group, column_name, na_count, total_rows, na_count > 0 AS has_na FROM na"""

ORACLE["sorted_autosomes"] = ORACLE["convert_autosomes"]

ORDER_RANK = """CASE WHEN TRY_CAST(seqnames AS INTEGER) BETWEEN 1 AND 22 THEN TRY_CAST(seqnames AS INTEGER)
                  WHEN seqnames = 'X' THEN 23 ELSE 1000 END"""

ORACLE["row_order"] = f"""WITH t0 AS (
  SELECT o_orderkey AS row_index, CAST(o_custkey % 23 AS VARCHAR) AS seqnames,
         CAST(floor(o_totalprice) AS INTEGER) AS start FROM orders
), t AS (SELECT row_index, {ORDER_RANK} AS rnk, start FROM t0),
l AS (SELECT row_index, rnk, start, lag(rnk) OVER w AS pr, lag(start) OVER w AS ps
      FROM t WINDOW w AS (ORDER BY row_index)),
v AS (SELECT row_index,
             CASE WHEN pr IS NOT NULL AND rnk < pr THEN 'rank'
                  WHEN pr IS NOT NULL AND rnk = pr AND start < ps THEN 'start' END AS kind FROM l)
SELECT CAST(count(*) AS BIGINT) AS rows_checked,
       CAST(count_if(kind = 'rank') AS BIGINT) AS rank_decreases,
       CAST(count_if(kind = 'start') AS BIGINT) AS start_decreases,
       CAST(min(row_index) FILTER (WHERE kind IS NOT NULL) + 1 AS BIGINT) AS first_bad_row,
       arg_min(kind, row_index) FILTER (WHERE kind IS NOT NULL) AS first_bad_kind,
       CASE WHEN count_if(kind IS NOT NULL) > 0 THEN 'orders' END AS first_bad_file,
       count_if(kind IS NOT NULL) = 0 AS ok
FROM v"""

CUSTOMERS = """customer JOIN nation ON c_nationkey = n_nationkey
     JOIN region ON n_regionkey = r_regionkey"""

ORACLE["discover_dirs"] = f"""
SELECT r_name AS study_name, c_name AS qtl_group,
       concat_ws('/', '/cov', r_name, c_name, 'bigwig') AS bigwig_dir
FROM {CUSTOMERS}
WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')"""

ORACLE["output_names"] = f"""
SELECT r_name AS study_name, c_name AS qtl_group,
       c_name || '_chr22_20000_60000.parquet' AS output_name,
       '/out/region=chr22_20000_60000/study_name=' || r_name || '/qtl_group=' || c_name
         AS output_path,
       'Will write: /out/region=chr22_20000_60000/study_name=' || r_name || '/qtl_group=' || c_name
         AS plan_line
FROM {CUSTOMERS}"""

INSPECT_RANK = """CASE WHEN TRY_CAST(regexp_replace(chrom, '^chr', '') AS INTEGER) IS NOT NULL
                       THEN TRY_CAST(regexp_replace(chrom, '^chr', '') AS INTEGER)
                     WHEN regexp_replace(chrom, '^chr', '') = 'X' THEN 23
                     WHEN regexp_replace(chrom, '^chr', '') = 'Y' THEN 24 ELSE 1000 END"""

SIZES = "sizes AS (SELECT file_path, chrom, CAST(max(end0) AS BIGINT) AS size FROM raw GROUP BY file_path, chrom)"

ORACLE["chrom_sort_head"] = f"""WITH {RAW}, {SIZES},
ranked AS (SELECT file_path, chrom, size,
                  CAST(row_number() OVER (PARTITION BY file_path ORDER BY {INSPECT_RANK}, chrom) AS INTEGER) AS rn
           FROM sizes)
SELECT * FROM ranked WHERE rn <= 10"""

ORACLE["head_intervals"] = f"""WITH {RAW},
ranked AS (SELECT file_path, chrom, CAST(start0 AS BIGINT) AS start0, CAST(end0 AS BIGINT) AS end0_, score,
                  CAST(row_number() OVER (PARTITION BY file_path, chrom ORDER BY start0, end0, score) AS INTEGER) AS rn
           FROM raw)
SELECT file_path, chrom, CAST(start0 AS INTEGER) AS start0, CAST(end0_ AS INTEGER) AS end0, score, rn
FROM ranked WHERE rn <= 10"""

ORACLE["first_chrom_head"] = f"""WITH {RAW}, {SIZES},
hits AS (SELECT r.file_path, r.chrom, r.start0, r.end0, r.score
         FROM raw r JOIN sizes s ON r.file_path = s.file_path AND r.chrom = s.chrom
         WHERE 1000000 < s.size AND r.start0 < s.size AND r.end0 > 1000000),
chroms AS (SELECT DISTINCT file_path, chrom FROM hits),
firstc AS (SELECT file_path, chrom FROM (
             SELECT file_path, chrom,
                    row_number() OVER (PARTITION BY file_path ORDER BY {INSPECT_RANK}, chrom) AS k
             FROM chroms) WHERE k = 1),
ranked AS (SELECT h.file_path, h.chrom, h.start0, h.end0, h.score,
                  CAST(row_number() OVER (PARTITION BY h.file_path ORDER BY h.start0, h.end0, h.score) AS INTEGER) AS rn
           FROM hits h JOIN firstc f ON h.file_path = f.file_path AND h.chrom = f.chrom)
SELECT * FROM ranked WHERE rn <= 10"""

ORACLE["na_rows"] = f"""{BASE}, {_converted(AUTOSOMES_WHERE)},
na AS (SELECT {COVERAGE_COLS},
              CAST(row_number() OVER (PARTITION BY study_name, qtl_group
                   ORDER BY seqnames, start, "end", sample_id, strand, score) AS INTEGER) AS rn
       FROM converted
       WHERE seqnames IS NULL OR start IS NULL OR "end" IS NULL OR strand IS NULL
             OR score IS NULL OR isnan(score) OR sample_id IS NULL)
SELECT * FROM na WHERE rn <= 5"""

ORACLE["sorted_write_readback"] = ORACLE["convert_region"]


def _report_row(seq: int, check: str, n_bad: str, detail: str, info: bool = False) -> str:
    status = ("'INFO'" if info else
              f"CASE WHEN ({n_bad}) IS NULL THEN 'SKIP' WHEN ({n_bad}) > 0 THEN 'FAIL' ELSE 'OK' END")
    return (f"SELECT study_name, qtl_group, CAST({seq} AS INTEGER) AS seq, '{check}' AS \"check\", "
            f"{status} AS status, CAST({n_bad} AS BIGINT) AS n_bad, {detail} AS detail FROM t")


ORACLE["validate_written"] = f"""{BASE}, {_converted(AUTOSOMES_WHERE)},
ranked AS (SELECT *, {ORDER_RANK} AS rnk FROM converted),
ordered AS (SELECT study_name, qtl_group, rnk, start,
                   lag(rnk) OVER w AS pr, lag(start) OVER w AS ps,
                   row_number() OVER w AS pos
            FROM ranked
            WINDOW w AS (PARTITION BY study_name, qtl_group
                         ORDER BY rnk, start, "end", sample_id)),
viol AS (SELECT study_name, qtl_group,
                count_if(pr IS NOT NULL AND rnk < pr) AS rank_dec,
                count_if(pr IS NOT NULL AND rnk = pr AND start < ps) AS start_dec,
                count(*) AS checked
         FROM ordered GROUP BY study_name, qtl_group),
chroms AS (SELECT study_name, qtl_group, seqnames, count(*) AS n, {COUNT_RANK} AS crank
           FROM converted GROUP BY study_name, qtl_group, seqnames),
counts AS (SELECT study_name, qtl_group, count(*) AS row_count,
                  count_if(seqnames IS NULL OR start IS NULL OR "end" IS NULL OR strand IS NULL
                           OR score IS NULL OR sample_id IS NULL) AS null_rows,
                  count_if(start < 1 OR "end" < start) AS bad_intervals,
                  count_if(strand <> '*') AS bad_strand,
                  count_if(seqnames <> '22') AS off_chrom,
                  count_if("end" < 20000) AS end_before,
                  count_if(start > 60000) AS start_after,
                  count(DISTINCT sample_id) AS n_samples
           FROM converted GROUP BY study_name, qtl_group),
t AS (SELECT c.*, v.rank_dec, v.start_dec, v.checked
      FROM counts c JOIN viol v USING (study_name, qtl_group))
{_report_row(1, 'schema', '0', "'every file has the columns and types of the coverage table'")}
UNION ALL {_report_row(2, 'row_count', 'CASE WHEN row_count > 0 THEN 0 ELSE 1 END', "CAST(row_count AS VARCHAR) || ' rows'")}
UNION ALL {_report_row(3, 'no_nulls', 'null_rows', "'rows with a NULL'")}
UNION ALL {_report_row(4, 'valid_intervals', 'bad_intervals', "'rows that start before 1 or end too early'")}
UNION ALL {_report_row(5, 'strand', 'bad_strand', "'rows on another strand than *'")}
UNION ALL SELECT study_name, qtl_group, CAST(6 AS INTEGER), 'chromosomes', 'INFO', CAST(NULL AS BIGINT),
                 seqnames || ':' || CAST(n AS VARCHAR) FROM chroms
UNION ALL {_report_row(7, 'expected_chrom', 'off_chrom', "'rows off chromosome 22'")}
UNION ALL {_report_row(8, 'expected_pos_start', 'end_before', "'rows ending before 20000'")}
UNION ALL {_report_row(9, 'expected_pos_end', 'start_after', "'rows starting after 60000'")}
UNION ALL {_report_row(10, 'samples', 'NULL', "CAST(n_samples AS VARCHAR) || ' samples'", info=True)}
UNION ALL {_report_row(11, 'row_order', 'rank_dec + start_dec',
                       "CASE WHEN rank_dec + start_dec = 0 THEN 'in order over ' "
                       "|| CAST(checked AS VARCHAR) || ' rows' END")}"""

# BigWig stores scores as float32: the round trip equals the converted table
# with each score rounded through FLOAT.
ORACLE["bigwig_roundtrip"] = f"""{BASE}, {_converted(AUTOSOMES_WHERE)}
SELECT study_name, qtl_group, seqnames, start, "end", strand,
       CAST(CAST(score AS FLOAT) AS DOUBLE) AS score, sample_id
FROM converted"""

ORACLE["bigwig_range"] = f"""WITH {RAW}
SELECT study_name, qtl_group,
       split_part(regexp_extract(file_path, '[^/]*$'), '.', 1) AS sample_id,
       chrom, CAST(start0 AS BIGINT) AS start0, CAST(end0 AS BIGINT) AS end0,
       CAST(CAST(score AS FLOAT) AS DOUBLE) AS score
FROM raw
WHERE replace(chrom, 'chr', '') = '22' AND start0 < 60000 AND end0 > 20000"""

ORACLE["bigwig_chrom_inventory"] = f"""WITH {RAW}
SELECT study_name, qtl_group, regexp_extract(file_path, '[^/]*$') AS file_name,
       CAST(count(DISTINCT chrom) AS BIGINT) AS n_chroms, true AS all_readable
FROM raw GROUP BY study_name, qtl_group, regexp_extract(file_path, '[^/]*$')"""

FILE_NAME = "regexp_extract(file_path, '[^/]*$')"

ORACLE["file_sizes"] = f"""WITH {RAW}
SELECT DISTINCT study_name, qtl_group, {FILE_NAME} AS file_name, true AS has_size FROM raw"""

MISSING = "CAST(regexp_extract(file_path, '/S([0-9]+)[.]', 1) AS INTEGER) % 5 = 0"

ORACLE["unreadable_files"] = f"""WITH {RAW},
files AS (SELECT DISTINCT study_name, qtl_group, {FILE_NAME} AS file_name, {MISSING} AS missing
          FROM raw)
SELECT study_name, qtl_group, count(*) AS sample_files,
       count(*) FILTER (missing) AS unreadable_files,
       coalesce(string_agg(file_name, ',' ORDER BY file_name) FILTER (missing), '')
         AS unreadable_names, true AS counts_agree
FROM files GROUP BY study_name, qtl_group"""

ORACLE["conversion_failures"] = f"""{BASE}, {_converted(AUTOSOMES_WHERE)},
counts AS (SELECT file_path, count(*) AS n FROM converted GROUP BY file_path),
files AS (SELECT DISTINCT study_name, qtl_group, file_path, {MISSING} AS missing FROM raw)
SELECT study_name, qtl_group, {FILE_NAME.replace("file_path", "files.file_path")} AS file_name,
       if(missing, 'all', 'none') AS parts_failed,
       CAST(if(missing, 0, coalesce(n, 0)) AS BIGINT) AS rows_written
FROM files LEFT JOIN counts ON files.file_path = counts.file_path"""

ORACLE["inspect_head"] = f"""WITH {RAW},
hits AS (SELECT regexp_extract(file_path, '^/cov/(.*)/[^/]*$', 1) AS directory,
                {FILE_NAME} AS file_name, chrom, CAST(start0 AS BIGINT) AS start0,
                CAST(end0 AS BIGINT) AS end0
         FROM raw WHERE replace(chrom, 'chr', '') = '22' AND end0 > 1000000)
SELECT directory, file_name, chrom, start0, end0
FROM (SELECT *, row_number() OVER (PARTITION BY directory, file_name, chrom
                                   ORDER BY start0, end0) AS k FROM hits) WHERE k = 1"""

ORACLE["convert_manifest_job"] = ORACLE["bigwig_roundtrip"]

ORACLE["job_rows_per_file"] = f"""{BASE}, {_converted(AUTOSOMES_WHERE)},
counts AS (SELECT file_path, count(*) AS n FROM converted GROUP BY file_path)
SELECT DISTINCT study_name, qtl_group, regexp_extract(raw.file_path, '[^/]*$') AS file_name,
       CAST(coalesce(n, 0) AS BIGINT) AS rows_written
FROM raw LEFT JOIN counts ON raw.file_path = counts.file_path"""

ORACLE["convert_study_job"] = f"""{BASE}, {_converted(REGION_22_WHERE)}
SELECT study_name, qtl_group, seqnames, start, "end", strand,
       CAST(CAST(score AS FLOAT) AS DOUBLE) AS score, sample_id
FROM converted WHERE study_name = 'study_1'"""

ORACLE["convert_directory_job"] = f"""{BASE}, {_converted(AUTOSOMES_WHERE)}
SELECT seqnames, start, "end", strand, CAST(CAST(score AS FLOAT) AS DOUBLE) AS score, sample_id
FROM converted WHERE study_name = 'study_0' AND qtl_group = 'grp_1'"""

ORACLE["region_tables_side_by_side"] = f"""{BASE}, {_converted(AUTOSOMES_WHERE)}
SELECT 'all' AS region, study_name, qtl_group, CAST(count(*) AS BIGINT) AS n
FROM converted GROUP BY study_name, qtl_group
UNION ALL
SELECT 'chr22' AS region, study_name, qtl_group, CAST(count(*) AS BIGINT) AS n
FROM converted WHERE seqnames = '22' GROUP BY study_name, qtl_group"""

ORACLE["incremental_pending"] = f"""WITH {RAW}
SELECT DISTINCT study_name, qtl_group, study_name <> 'study_0' AS pending,
       study_name = 'study_0' AS published FROM raw"""

ORACLE["na_rows_written"] = f"""{BASE}, {_converted(AUTOSOMES_WHERE)},
na AS (SELECT {COVERAGE_COLS},
              CAST(row_number() OVER (PARTITION BY study_name, qtl_group
                   ORDER BY {ORDER_RANK}, start, "end", sample_id) AS INTEGER) AS rn
       FROM converted WHERE score IS NULL)
SELECT * FROM na WHERE rn <= 5"""

ORACLE["ordered_directories"] = f"""
SELECT *, CAST(row_number() OVER (PARTITION BY study_name ORDER BY qtl_group) AS INTEGER) AS place
FROM ({ORACLE['discover_dirs']})"""

ORACLE["republish_fewer_chromosomes"] = f"""{BASE}, {_converted(AUTOSOMES_WHERE)}
SELECT study_name, qtl_group, seqnames, CAST(count(*) AS BIGINT) AS n, min(start) AS first_start,
       max("end") AS last_end
FROM converted WHERE qtl_group = 'grp_1' OR CAST(seqnames AS INTEGER) <= 11
GROUP BY study_name, qtl_group, seqnames"""

ORACLE["region_among_long_intervals"] = f"""WITH {RAW.replace("raw AS", "given AS")},
raw AS (SELECT * REPLACE (CASE WHEN start0 % 11 = 0 THEN start0 + 50000 ELSE end0 END AS end0)
        FROM given), {CONV},
{_converted("seqnames = '1' AND \"end\" >= 100000 AND start <= 100500")}
SELECT {COVERAGE_COLS} FROM converted"""

ORACLE["damaged_files_job"] = f"""WITH {RAW},
damaged AS (SELECT DISTINCT study_name, qtl_group, file_path, {FILE_NAME} AS file_name FROM raw
            WHERE {FILE_NAME} IN ('S3.rep0.bw', 'S5.rep1.bigwig', 'S7.rep0.bw'))
SELECT study_name, qtl_group, file_name,
       CASE file_name WHEN 'S3.rep0.bw' THEN 'index' WHEN 'S5.rep1.bigwig' THEN 'block'
                      ELSE 'range' END AS kind, false AS published,
       CAST(row_number() OVER (ORDER BY file_path) AS INTEGER) AS place
FROM damaged"""


def _columns_text(names: list[str]) -> str:
    return str(names).replace("'", "''")


_BAD_TABLE = "study_name = 'study_1' AND qtl_group = 'grp_0'"
_SKIPPED = ", ".join(f"({k + 1}, '{name}')" for k, name in enumerate(CHECKS) if k)
_WANTED = ["seqnames", "start", "end", "strand", "score", "sample_id"]
_SWAPPED = ["start", "seqnames", *_WANTED[2:]]
ORACLE["validate_with_a_bad_file"] = f"""SELECT * FROM ({ORACLE['validate_written']})
WHERE NOT ({_BAD_TABLE})
UNION ALL SELECT 'study_1', 'grp_0', 1, 'schema', 'FAIL', 1,
  'part-00000-swapped.parquet: columns are {_columns_text(_SWAPPED)}; '
  || 'the coverage table has {_columns_text(_WANTED)}'
UNION ALL SELECT 'study_1', 'grp_0', k, name, 'SKIP', NULL, NULL
FROM (VALUES {_SKIPPED}) checks(k, name)"""

ORACLE["mixed_names_roundtrip"] = f"""WITH {RAW},
named AS (
  SELECT study_name, qtl_group, 'S' || regexp_extract(file_path, 'S([0-9]+)[.]', 1) AS sample_id,
         unnest(CASE WHEN start0 % 3 = 0 THEN ['chr1', '1'] WHEN suffix(file_path, '.bw')
                     THEN ['chr1'] ELSE ['1'] END) AS chrom,
         CAST(start0 AS BIGINT) AS start0, CAST(end0 AS BIGINT) AS end0,
         CASE WHEN isnan(score) THEN NULL ELSE CAST(CAST(score AS FLOAT) AS DOUBLE) END AS score
  FROM raw)
SELECT 'converted' AS view, study_name, qtl_group, sample_id, '1' AS seqnames,
       start0 + 1 AS first, end0 AS last, score
FROM named WHERE end0 >= start0 + 1
UNION ALL
SELECT 'range of ' || chrom, study_name, qtl_group, sample_id, chrom, start0, end0, score
FROM named WHERE start0 < 200000 AND end0 > 100000"""

ORACLE["inspect_tree"] = """
WITH files AS (
  SELECT CASE WHEN r_name = 'ASIA' THEN 'ASIA' ELSE r_name || '/' || n_name || '/' || c_mktsegment END
         || '/' || c_name || '.bw' AS file, c_custkey % 7 = 0 AS broken
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
placed AS (
  SELECT file, broken,
         CAST(row_number() OVER (ORDER BY string_split(file, '/')) AS INTEGER) AS position
  FROM files),
totals AS (SELECT count(*) AS total_files, count_if(NOT broken) AS readable,
                  count_if(broken) AS unreadable FROM files)
SELECT position, file, regexp_extract(file, '[^/]*$') AS file_name,
       'not a BigWig file (bad magic number)' AS message,
       CAST(total_files AS BIGINT) AS total_files, CAST(readable AS BIGINT) AS readable,
       CAST(unreadable AS BIGINT) AS unreadable
FROM placed, totals WHERE broken"""

ORACLE["bigwig_source_scan"] = f"""WITH {RAW}
SELECT study_name, qtl_group, split_part({FILE_NAME}, '.', 1) AS sample_id, chrom,
       CAST(start0 AS BIGINT) AS start0, CAST(end0 AS BIGINT) AS end0,
       CASE WHEN isnan(score) THEN NULL ELSE CAST(CAST(score AS FLOAT) AS DOUBLE) END AS score
FROM raw WHERE chrom = 'chr22' AND start0 < 60000 AND end0 > 20000"""

ORACLE["stream_resumes"] = f"""{BASE}, {_converted(AUTOSOMES_WHERE)}
SELECT study_name, qtl_group,
       CAST(CASE WHEN study_name = 'study_2' AND qtl_group = 'grp_1' THEN 2 ELSE 1 END AS BIGINT)
         AS n_converted,
       CAST(count(*) AS BIGINT) AS rows_written,
       CAST(CASE WHEN study_name = 'study_0' AND qtl_group = 'grp_1' THEN 1 ELSE 0 END AS BIGINT)
         AS n_rejected
FROM converted GROUP BY study_name, qtl_group"""
