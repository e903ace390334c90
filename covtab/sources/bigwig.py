"""BigWig scans as Spark jobs.

    files ──mapInArrow(index)──> chunks ──repartition(n)──> mapInArrow(decode) ──> intervals

* index: per file, read the header, chromosome tree and R-tree leaves; drop
  blocks of chromosomes that are not wanted (F1, after 'chr' removal) and
  blocks outside the region (F3) — so a one-region job never inflates the rest
  of the genome. Runs of adjacent surviving blocks are cut into byte ranges
  of about ``chunk_bytes`` — one constant-size row each, however many blocks.
* repartition: chunk rows are tiny, so a round-robin shuffle spreads the
  chunks of one large file over every task — a file holding a third of all
  data is decoded by many tasks at once.
* decode: each task reads its chunk's byte span once, walks and inflates the
  blocks (zlib streams end by themselves) and parses them with numpy; rows
  leave as bounded Arrow batches.

Every stage reports failures as rows with a non-NULL ``error`` (file_path
set, data columns NULL) instead of failing the task, so a caller can list all
unreadable files before publishing anything (A3).
Paths must be readable from every executor: a shared POSIX path, or a URI
that ``pyarrow.fs`` understands.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covtab.region import RegionSpec
from covtab.sources.bigwig_format import (SECTION_HEADER_SIZE, BigWigError, decode_section,
                                          read_chroms, read_exact, read_header,
                                          read_index_leaves, section_size)

INTERVAL_SCHEMA = ("study_name string, qtl_group string, file_path string, chrom string, "
                   "start0 long, end0 long, score double, error string")
CHROM_SCHEMA = ("study_name string, qtl_group string, file_path string, chrom string, "
                "chrom_id int, size long, error string")

NO_CHROMS = "the file lists no chromosome"


def open_file(path: str):
    """Random-access binary handle for a local path or a pyarrow.fs URI."""
    if "://" in path and not path.startswith("file://"):
        from pyarrow import fs as pafs
        filesystem, p = pafs.FileSystem.from_uri(path)
        return filesystem.open_input_file(p)
    if path.startswith("file:"):
        from urllib.parse import unquote, urlparse
        path = unquote(urlparse(path).path)
    return open(path, "rb")


def _const(value, n: int, typ=pa.string()) -> pa.Array:
    if value is None:
        return pa.nulls(n, typ)
    return pa.DictionaryArray.from_arrays(pa.array(np.zeros(n, dtype=np.int32)),
                                          pa.array([value], typ)).cast(typ)


def _col(batch: pa.RecordBatch, name: str) -> list:
    i = batch.schema.get_field_index(name)
    return batch.column(i).to_pylist() if i >= 0 else [None] * batch.num_rows


def _error_row(schema: pa.Schema, study, group, path, msg) -> pa.RecordBatch:
    vals = {"study_name": study, "qtl_group": group, "file_path": path, "error": msg}
    return pa.RecordBatch.from_arrays(
        [pa.array([vals.get(f.name)], f.type) for f in schema], schema=schema)


# ----------------------------------------------------------------- index stage

DEFAULT_CHUNK_BYTES = 64 << 20          # compressed bytes of data blocks per chunk
MAX_BATCH_ROWS = 1 << 16                 # rows per Arrow batch leaving a decode task (~7 MB)


def index_file(path: str, keep: set[str] | None, bounds: tuple[int | None, int | None] | None,
               chunk_bytes: int = DEFAULT_CHUNK_BYTES, normalize: bool = True,
               within: tuple[int, int] | None = None) -> list[tuple]:
    """Read one file's header, chromosome tree and R-tree; keep the blocks of
    wanted chromosomes (names compared after 'chr' removal when
    ``normalize``, else exactly) that may hold rows with end0 >= lo and
    start0 < hi, and that begin ``within`` a range of the file's bytes; cut runs
    of adjacent kept blocks into byte ranges of about ``chunk_bytes``. Returns
    chunk tuples
    (chunk, compressed, lo, hi, n_blocks, keep_ids, keep_names, stretches) — a
    bounded description, whatever the number of blocks; the names are those of
    the kept chromosomes that the chunk's blocks hold, and the stretches tell
    how its bytes spread over chromosomes and starts."""
    with open_file(path) as f:
        h = read_header(f)
        chroms = read_chroms(f, h)
        if not chroms:
            raise BigWigError(NO_CHROMS)
        if keep is None:
            kept = chroms
        else:
            kept = [c for c in chroms if (c[0].replace("chr", "") if normalize else c[0]) in keep]
        if not kept:
            return []
        keep_ids = np.array([c[1] for c in kept], dtype=np.int64)
        keep_names = [c[0] for c in kept]
        # pruned traversal: only subtrees that may hold wanted rows are read
        sel = read_index_leaves(f, h, None if keep is None else keep_ids, bounds)
    if within is not None:
        sel = sel[(sel["off"] >= within[0]) & (sel["off"] < within[1])]
    n = len(sel)
    if n == 0:
        return []
    off = sel["off"].astype(np.int64)
    size = sel["size"].astype(np.int64)
    # a chunk never spans a gap (skipped blocks) and holds about chunk_bytes
    new_run = np.ones(n, dtype=bool)
    new_run[1:] = off[1:] != off[:-1] + size[:-1]
    run_start = off[new_run][np.cumsum(new_run) - 1]
    bucket = (off - run_start) // max(1, int(chunk_bytes))
    cut = new_run.copy()
    cut[1:] |= bucket[1:] != bucket[:-1]
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], n)
    order = np.argsort(keep_ids, kind="stable")
    ids, names = keep_ids[order], [keep_names[k] for k in order]

    def own(a: int, b: int) -> tuple[list[int], list[str]]:
        i = int(np.searchsorted(ids, int(sel["sc"][a:b].min()), "left"))
        j = int(np.searchsorted(ids, int(sel["ec"][a:b].max()), "right"))
        return ids[i:j].tolist(), names[i:j]
    name_of = dict(zip(ids.tolist(), names, strict=True))
    return [(k, h.uncompress_buf_size > 0, int(off[a]), int(off[b - 1] + size[b - 1]),
             int(b - a), *own(a, b), _stretches(sel[a:b], name_of))
            for k, (a, b) in enumerate(zip(starts.tolist(), ends.tolist()))]


CHUNK_STRETCHES = 64  # of one chromosome and chunk, about


def _stretches(blocks: np.ndarray, name_of: dict[int, str]) -> list[dict]:
    """Chromosome, first start and bytes of stretches of adjacent blocks."""
    chrom = blocks["sc"].astype(np.int64)
    place = np.arange(len(blocks)) * CHUNK_STRETCHES // len(blocks)
    first = np.flatnonzero(np.concatenate(
        ([True], (chrom[1:] != chrom[:-1]) | (place[1:] != place[:-1]))))
    size = np.add.reduceat(blocks["size"].astype(np.int64), first)
    return [{"chrom": name_of.get(int(c)), "start": int(s), "bytes": int(n)}
            for c, s, n in zip(chrom[first], blocks["sb"][first], size, strict=True)]


def iter_blocks(span: bytes, compressed: bool, n_blocks: int):
    """Walk ``n_blocks`` adjacent data blocks of a byte span, yielding each
    inflated block. zlib streams end by themselves; an uncompressed block's
    length follows from its header (type and item count)."""
    mv = memoryview(span)
    pos = 0
    # feed each zlib stream about twice the average block size; the loop below
    # extends the window for larger blocks, and the copy of ``unused_data``
    # stays about one block long instead of a whole buffer
    step = max(4096, 2 * (len(span) // max(1, n_blocks)))
    for _ in range(n_blocks):
        if compressed:
            d = zlib.decompressobj()
            parts, fed = [], pos
            while not d.eof:
                if fed >= len(span):
                    raise BigWigError("data block runs past the end of its chunk")
                piece = mv[fed:fed + step]
                parts.append(d.decompress(piece))
                fed += len(piece)
            pos = fed - len(d.unused_data)
            yield b"".join(parts)
        else:
            size = section_size(mv[pos:pos + SECTION_HEADER_SIZE])
            if pos + size > len(span):
                raise BigWigError("data block runs past the end of its chunk")
            yield mv[pos:pos + size]
            pos += size
    if pos != len(span):
        raise BigWigError(f"chunk has {len(span) - pos} bytes after its last block")


def decode_range(f, compressed: bool, lo: int, hi: int, n_blocks: int,
                 keep_ids: list[int], max_rows: int = MAX_BATCH_ROWS):
    """Decode the blocks in [lo, hi): yields (chrom position in keep_ids,
    start0, end0, score) arrays of at most about ``max_rows`` rows."""
    id_to_pos = {cid: i for i, cid in enumerate(keep_ids)}
    span = read_exact(f, lo, hi - lo)
    cids, starts, ends, vals, rows = [], [], [], [], 0
    for raw in iter_blocks(span, compressed, n_blocks):
        cid, s, e, v = decode_section(raw, False)
        pos = id_to_pos.get(cid)
        if pos is None:
            continue
        cids.append(np.full(len(s), pos, dtype=np.int32))
        starts.append(s)
        ends.append(e)
        vals.append(v)
        rows += len(s)
        if rows >= max_rows:
            yield (np.concatenate(cids), np.concatenate(starts).astype(np.int64),
                   np.concatenate(ends).astype(np.int64), np.concatenate(vals).astype(np.float64))
            cids, starts, ends, vals, rows = [], [], [], [], 0
    if rows:
        yield (np.concatenate(cids), np.concatenate(starts).astype(np.int64),
               np.concatenate(ends).astype(np.int64), np.concatenate(vals).astype(np.float64))


_CHUNK_ARROW = pa.schema([
    ("study_name", pa.string()), ("qtl_group", pa.string()), ("file_path", pa.string()),
    ("chunk", pa.int64()), ("compressed", pa.bool_()),
    ("lo", pa.int64()), ("hi", pa.int64()), ("n_blocks", pa.int64()),
    ("keep_ids", pa.list_(pa.int32())), ("keep_names", pa.list_(pa.string())),
    ("stretches", pa.list_(pa.struct([("chrom", pa.string()), ("start", pa.int64()),
                                      ("bytes", pa.int64())]))),
    ("error", pa.string())])


def _index_fn(keep: list[str] | None, bounds: tuple[int | None, int | None] | None,
              chunk_bytes: int):
    keep_set = set(keep) if keep is not None else None
    schema = _CHUNK_ARROW

    def fn(batches):
        for batch in batches:
            studies, groups, paths = (_col(batch, "study_name"), _col(batch, "qtl_group"),
                                      _col(batch, "file_path"))
            for study, group, path in zip(studies, groups, paths):
                try:
                    rows = [(study, group, path, *c, None) for c in
                            index_file(path, keep_set, bounds, chunk_bytes)]
                except Exception as e:  # noqa: BLE001 - reported as an error row
                    yield _error_row(schema, study, group, path, str(e) or type(e).__name__)
                    continue
                if rows:
                    cols = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), t.type) for c, t in zip(cols, schema)], schema=schema)
    return fn


# ---------------------------------------------------------------- decode stage

def _decode_fn():
    schema = pa.schema([
        ("study_name", pa.string()), ("qtl_group", pa.string()), ("file_path", pa.string()),
        ("chrom", pa.string()), ("start0", pa.int64()), ("end0", pa.int64()),
        ("score", pa.float64()), ("error", pa.string())])

    def fn(batches):
        for batch in batches:
            cols = {n: _col(batch, n) for n in batch.schema.names}
            for i in range(batch.num_rows):
                study, group, path = cols["study_name"][i], cols["qtl_group"][i], cols["file_path"][i]
                if cols["error"][i] is not None:
                    yield _error_row(schema, study, group, path, cols["error"][i])
                    continue
                names = pa.array(cols["keep_names"][i], pa.string())
                out = []
                try:
                    with open_file(path) as f:
                        for pos, s, e, v in decode_range(
                                f, cols["compressed"][i], cols["lo"][i], cols["hi"][i],
                                cols["n_blocks"][i], cols["keep_ids"][i]):
                            n = len(s)
                            chrom = pa.DictionaryArray.from_arrays(pa.array(pos), names)
                            out.append(pa.RecordBatch.from_arrays(
                                [_const(study, n), _const(group, n), _const(path, n),
                                 chrom.cast(pa.string()), pa.array(s), pa.array(e), pa.array(v),
                                 pa.nulls(n, pa.string())], schema=schema))
                            if len(out) > 1:      # keep at most one batch in hand
                                yield out.pop(0)
                except Exception as ex:  # noqa: BLE001 - reported as an error row
                    # batches are streamed to bound memory, so rows of this
                    # chunk emitted before the failure stay; the error row
                    # marks the file as failed and the conversion gate then
                    # publishes nothing. The held-back batch is dropped.
                    out = []
                    yield _error_row(schema, study, group, path,
                                     f"chunk {cols['chunk'][i]}: {ex or type(ex).__name__}")
                yield from out
    return fn


def _files(files: DataFrame) -> DataFrame:
    cols = [F.col(c) if c in files.columns else F.lit(None).cast("string").alias(c)
            for c in ("study_name", "qtl_group")]
    return files.select(*cols, "file_path")


def _parallelism(df: DataFrame, n: int | None) -> int:
    return n or max(1, df.sparkSession.sparkContext.defaultParallelism)


CHUNK_SCHEMA = ("study_name string, qtl_group string, file_path string, chunk long, "
                "compressed boolean, lo long, hi long, n_blocks long, "
                "keep_ids array<int>, keep_names array<string>, "
                "stretches array<struct<chrom: string, start: long, bytes: long>>, error string")


def bigwig_chunks(files: DataFrame, region: RegionSpec | None = None,
                  chunk_bytes: int = DEFAULT_CHUNK_BYTES, num_partitions: int | None = None,
                  all_chroms: bool = False) -> DataFrame:
    """Index stage: one row per byte-range chunk of surviving data blocks (or
    per failed file). ``all_chroms`` keeps every chromosome (raw scan, no F1)."""
    region = region or RegionSpec()
    keep = None if all_chroms else region.allowed_chroms
    bounds = None
    if region.pos_start is not None or region.pos_end is not None:
        bounds = (region.pos_start, region.pos_end)
    return index_chunks(files, keep, bounds, chunk_bytes, num_partitions)


def index_chunks(files: DataFrame, keep: list[str] | None, bounds: tuple | None,
                 chunk_bytes: int = DEFAULT_CHUNK_BYTES,
                 num_partitions: int | None = None) -> DataFrame:
    """Index stage with explicit pruning: ``keep`` = chromosome names after
    'chr' removal (None = all), ``bounds`` = (lo, hi) keeping blocks that may
    hold rows with end0 >= lo and start0 < hi (either may be None)."""
    n = _parallelism(files, num_partitions)
    return (_files(files).repartition(n)
            .mapInArrow(_index_fn(keep, bounds, chunk_bytes), CHUNK_SCHEMA))


def decode_chunks(chunks: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Decode stage: chunk rows (tiny) are spread round-robin over
    ``num_partitions`` tasks, each inflating its byte ranges."""
    n = _parallelism(chunks, num_partitions)
    return chunks.drop("stretches").repartition(n).mapInArrow(_decode_fn(), INTERVAL_SCHEMA)


def decode_partitions(chunks: DataFrame, target_task_bytes: int = 128 << 20) -> int:
    """Decode parallelism sized by data: enough tasks for every core, and
    about ``target_task_bytes`` of compressed blocks per task."""
    sc = chunks.sparkSession.sparkContext
    r = chunks.agg(F.count(F.lit(1)).alias("n"),
                   F.sum(F.col("hi") - F.col("lo")).alias("b")).collect()[0]
    by_bytes = -(-int(r["b"] or 0) // max(1, int(target_task_bytes)))
    return max(1, sc.defaultParallelism, min(int(r["n"] or 0), by_bytes))


def scan_bigwig(files: DataFrame, region: RegionSpec | None = None,
                chunk_bytes: int = DEFAULT_CHUNK_BYTES, num_partitions: int | None = None,
                all_chroms: bool = False) -> DataFrame:
    """Raw 0-based intervals of every file (``files`` has file_path and
    optionally study_name, qtl_group), plus error rows. Block pruning by
    chromosome allow-list and region happens in the index stage; the exact
    row filters are left to ``convert_intervals``."""
    chunks = bigwig_chunks(files, region, chunk_bytes, num_partitions, all_chroms)
    return decode_chunks(chunks, num_partitions)


def _range_index_fn(chrom: str, start: int, end: int | None, chunk_bytes: int):
    schema = _CHUNK_ARROW

    def pick(path: str) -> tuple[str, int]:
        with open_file(path) as f:
            sizes = {c[0]: c[2] for c in read_chroms(f, read_header(f))}
        if not sizes:
            raise BigWigError(NO_CHROMS)
        loose = [c for c in sizes if c.replace("chr", "") == chrom.replace("chr", "")]
        name = chrom if chrom in sizes else min(loose, default=None)
        if name is None:
            raise BigWigError(f"has no chromosome {chrom}")
        stop = sizes[name] if end is None else min(end, sizes[name])
        if start >= stop:
            raise BigWigError(f"range {start} to {stop} of chromosome {name} is empty")
        return name, stop

    def fn(batches):
        for batch in batches:
            studies, groups, paths = (_col(batch, "study_name"), _col(batch, "qtl_group"),
                                      _col(batch, "file_path"))
            for study, group, path in zip(studies, groups, paths):
                try:
                    name, stop = pick(path)
                    rows = [(study, group, path, *c, None) for c in index_file(
                        path, {name}, (start + 1, stop), chunk_bytes, normalize=False)]
                except Exception as e:  # noqa: BLE001 - reported as an error row
                    yield _error_row(schema, study, group, path, str(e) or type(e).__name__)
                    continue
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), t.type) for c, t in
                         zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
    return fn


def scan_bigwig_range(files: DataFrame, chrom: str, start: int = 0, end: int | None = None,
                      chunk_bytes: int = DEFAULT_CHUNK_BYTES,
                      num_partitions: int | None = None) -> DataFrame:
    """Intervals overlapping [start, end) of one chromosome, 0-based,
    exact name first and the 'chr'-less name as fallback; ``end`` defaults
    to and is clamped to the chromosome size. Intervals are not clipped.
    Each header is read once, only blocks that overlap the range are inflated,
    and a file that cannot be read, lacks the chromosome or ends before the
    range gives an error row."""
    check_range(start, end)
    n = _parallelism(files, num_partitions)
    chunks = _files(files).repartition(n).mapInArrow(
        _range_index_fn(chrom, start, end, chunk_bytes), CHUNK_SCHEMA)
    inside = F.col("end0") > start
    if end is not None:
        inside = inside & (F.col("start0") < end)
    return decode_chunks(chunks, num_partitions).filter(F.col("error").isNotNull() | inside)


def check_range(start: int, end: int | None) -> None:
    if start < 0:
        raise ValueError("start must not be negative")
    if end is not None and end <= start:
        raise ValueError("end must lie beyond start")


def without_errors(scan: DataFrame) -> DataFrame:
    """A scan's rows; its first error row, if any, fails the query."""
    failure = F.when(F.col("error").isNotNull(), F.raise_error(
        F.concat(F.col("file_path"), F.lit(": "), F.col("error"))))
    return scan.filter(failure.cast("string").isNull()).drop("error")


# ------------------------------------------------------------ chromosome sizes

def _chroms_fn():
    schema = pa.schema([
        ("study_name", pa.string()), ("qtl_group", pa.string()), ("file_path", pa.string()),
        ("chrom", pa.string()), ("chrom_id", pa.int32()), ("size", pa.int64()),
        ("error", pa.string())])

    def fn(batches):
        for batch in batches:
            for study, group, path in zip(_col(batch, "study_name"), _col(batch, "qtl_group"),
                                          _col(batch, "file_path")):
                try:
                    with open_file(path) as f:
                        chroms = read_chroms(f, read_header(f))
                    if not chroms:
                        raise BigWigError(NO_CHROMS)
                except Exception as e:  # noqa: BLE001 - reported as an error row
                    yield _error_row(schema, study, group, path, str(e) or type(e).__name__)
                    continue
                n = len(chroms)
                yield pa.RecordBatch.from_arrays(
                    [_const(study, n), _const(group, n), _const(path, n),
                     pa.array([c[0] for c in chroms], pa.string()),
                     pa.array([c[1] for c in chroms], pa.int32()),
                     pa.array([c[2] for c in chroms], pa.int64()),
                     pa.nulls(n, pa.string())], schema=schema)
    return fn


def chrom_sizes(files: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """(file, chrom, chrom_id, size) for every file; error rows for
    files that cannot be read or list no chromosome."""
    n = _parallelism(files, num_partitions)
    return _files(files).repartition(n).mapInArrow(_chroms_fn(), CHROM_SCHEMA)


def readability(files: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """A4: (file_path, ok, message); message is '<n> chromosomes' or the error."""
    cs = chrom_sizes(files, num_partitions)
    return (cs.groupBy("study_name", "qtl_group", "file_path")
              .agg(F.count("chrom").alias("n_chroms"), F.max("error").alias("error"))
              .select("study_name", "qtl_group", "file_path",
                      F.col("error").isNull().alias("ok"),
                      F.coalesce(F.col("error"),
                                 F.concat(F.col("n_chroms").cast("string"), F.lit(" chromosomes")))
                      .alias("message")))


# ------------------------------------------------------------ head of a file

HEAD_SCHEMA = ("file_path string, chrom string, start0 long, end0 long, score double, rn int, "
               "error string")


HEAD_READ_BLOCKS = 16  # adjacent blocks that the head reads at once


def _runs(leaves: np.ndarray):
    """Index ranges of adjacent blocks, short ones first: a head often needs
    one block only."""
    a, n, most = 0, len(leaves), 1
    ends = leaves["off"].astype(np.int64) + leaves["size"].astype(np.int64)
    while a < n:
        b = a + 1
        while b < n and b - a < most and int(leaves["off"][b]) == int(ends[b - 1]):
            b += 1
        yield a, b
        a, most = b, HEAD_READ_BLOCKS


def _head_fn(start: int, end: int | None, n: int, chrom: str | None):
    schema = pa.schema([("file_path", pa.string()), ("chrom", pa.string()),
                        ("start0", pa.int64()), ("end0", pa.int64()), ("score", pa.float64()),
                        ("rn", pa.int32()), ("error", pa.string())])

    def head_of(path, order):
        with open_file(path) as f:
            h = read_header(f)
            for item in order:
                name, cid, size = item["chrom"], item["chrom_id"], item["size"]
                q_end = size if end is None else min(end, size)
                if start >= q_end:
                    continue                      # shorter than the start: next one
                leaves = read_index_leaves(f, h, np.array([cid], dtype=np.int64),
                                           (start + 1, q_end))
                got, n_got = [], 0
                for a, b in _runs(leaves):        # file order = start order
                    span = read_exact(f, int(leaves["off"][a]), int(
                        leaves["off"][b - 1] + leaves["size"][b - 1] - leaves["off"][a]))
                    for raw in iter_blocks(span, h.uncompress_buf_size > 0, b - a):
                        bcid, s, e, v = decode_section(raw, False)
                        keep = (s.astype(np.int64) < q_end) & (e.astype(np.int64) > start)
                        if bcid == cid and keep.any():
                            got.append((s[keep], e[keep], v[keep]))
                            n_got += int(keep.sum())
                    if n_got >= n:
                        break
                if n_got:
                    return name, *(np.concatenate(x)[:n] for x in zip(*got, strict=True))
        return None

    def fn(batches):
        for batch in batches:
            for path, order in zip(_col(batch, "file_path"), _col(batch, "chroms")):
                try:
                    if not order and chrom is not None:
                        raise BigWigError(f"has no chromosome {chrom}")
                    found = head_of(path, order or [])
                except Exception as ex:  # noqa: BLE001 - reported as an error row
                    yield _error_row(schema, None, None, path, str(ex) or type(ex).__name__)
                    continue
                if found is None:
                    yield _error_row(schema, None, None, path, "no interval in the range")
                    continue
                name, s, e, v = found
                k = len(s)
                yield pa.RecordBatch.from_arrays(
                    [_const(path, k), _const(name, k), pa.array(s.astype(np.int64)),
                     pa.array(e.astype(np.int64)), pa.array(v.astype(np.float64)),
                     pa.array(np.arange(1, k + 1, dtype=np.int32)), pa.nulls(k, pa.string())],
                    schema=schema)
    return fn


def bigwig_head(files: DataFrame, start: int = 0, end: int | None = None, n: int = 10,
                chrom: str | None = None, num_partitions: int | None = None,
                sizes: DataFrame | None = None) -> DataFrame:
    """O7 + O6 read straight from the files: per file, the first chromosome
    (inspector order P8; or ``chrom``: exact name, else the 'chr'-less one)
    with an interval overlapping [start, min(end, size)), and its first ``n``
    such intervals in file order. Each file reads only the index nodes and
    blocks it needs and stops at the first chromosome with data — never the
    whole file. A file that cannot be read, lacks ``chrom``, or has no interval
    there gives an error row. The chromosome order is computed by Spark (one
    definition of P8); the walk is per file inside ``mapInArrow``."""
    from covtab.functions.chrom import inspect_rank

    sizes = chrom_sizes(files, num_partitions) if sizes is None else sizes
    none = F.lit(None)
    broken = sizes.filter(F.col("error").isNotNull()).select(
        "file_path", *[none.cast(t).alias(c) for c, t in (
            ("chrom", "string"), ("start0", "long"), ("end0", "long"), ("score", "double"),
            ("rn", "int"))], "error")
    good = sizes.filter(F.col("error").isNull())
    wanted = F.lit(0)
    if chrom is not None:
        loose = F.replace(F.col("chrom"), F.lit("chr"), F.lit("")) == chrom.replace("chr", "")
        wanted = F.when(F.col("chrom") == chrom, 0).when(loose, 1)
    entry = F.struct(wanted.alias("k0"), inspect_rank("chrom").alias("rank"), "chrom",
                     "chrom_id", "size")
    order = (good.groupBy("file_path")
             .agg(F.array_sort(F.collect_list(F.when(wanted.isNotNull(), entry)))
                  .alias("chroms")))
    if chrom is not None:  # the exact name alone, where the file has it
        order = order.withColumn("chroms", F.slice("chroms", 1, 1))
    n_part = _parallelism(files, num_partitions)
    found = order.repartition(n_part).mapInArrow(_head_fn(start, end, n, chrom), HEAD_SCHEMA)
    return found.unionByName(broken)
