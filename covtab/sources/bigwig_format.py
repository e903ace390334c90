"""Binary layout of BigWig files (Kent et al. 2010), read with struct/numpy.

Only what a scan needs: the header, the chromosome B+ tree, the R-tree leaves
and the three data-section encodings. Zoom levels and summaries are skipped.
All integers are little-endian; a byte-swapped file is reported as an error.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

# Fixed values of the file format.
BIGWIG_MAGIC = 0x888FFC26
CHROM_TREE_MAGIC = 0x78CA8C91
RTREE_MAGIC = 0x2468ACE0
HEADER_SIZE = 64
SECTION_HEADER_SIZE = 24
SECTION_BEDGRAPH, SECTION_VARSTEP, SECTION_FIXEDSTEP = 1, 2, 3

_HEADER = struct.Struct("<IHHQQQHHQQIQ")
_BPT_HEADER = struct.Struct("<IIIIQQ")
_RT_HEADER = struct.Struct("<IIQIIIIQII")
_NODE = struct.Struct("<BBH")
_SECTION = struct.Struct("<IIIIIBBH")

RT_LEAF = np.dtype([("sc", "<u4"), ("sb", "<u4"), ("ec", "<u4"), ("eb", "<u4"),
                    ("off", "<u8"), ("size", "<u8")])
RT_INNER = np.dtype([("sc", "<u4"), ("sb", "<u4"), ("ec", "<u4"), ("eb", "<u4"),
                     ("off", "<u8")])
BEDGRAPH_ITEM = np.dtype([("s", "<u4"), ("e", "<u4"), ("v", "<f4")])
VARSTEP_ITEM = np.dtype([("s", "<u4"), ("v", "<f4")])


class BigWigError(ValueError):
    pass


@dataclass(frozen=True)
class Header:
    version: int
    zoom_levels: int
    chrom_tree_offset: int
    full_data_offset: int
    full_index_offset: int
    uncompress_buf_size: int


def read_exact(f, offset: int, size: int) -> bytes:
    f.seek(offset)
    b = f.read(size)
    if len(b) != size:
        raise BigWigError(f"truncated file: wanted {size} bytes at offset {offset}, got {len(b)}")
    return b


def read_header(f) -> Header:
    b = read_exact(f, 0, HEADER_SIZE)
    magic = struct.unpack_from("<I", b)[0]
    if magic != BIGWIG_MAGIC:
        if struct.unpack_from(">I", b)[0] == BIGWIG_MAGIC:
            raise BigWigError("big-endian BigWig files are not supported")
        raise BigWigError("not a BigWig file (bad magic number)")
    (_, version, zoom, ctree, data, index, _fc, _dfc, _asql, _tsum, ubuf, _ext) = _HEADER.unpack(b)
    return Header(version, zoom, ctree, data, index, ubuf)


def _visit(seen: set[int], offset: int, tree: str) -> None:
    if offset in seen:
        raise BigWigError(f"{tree} visits one node twice")
    seen.add(offset)


def _read_node(f, offset: int, leaf_size: int, inner_size: int, block: int
               ) -> tuple[bool, int, bytes]:
    """A tree node: whether it is a leaf, its number of items, their bytes. One
    read covers a node of up to ``block`` items; files may end within it."""
    f.seek(offset)
    b = f.read(_NODE.size + min(block, 65535) * max(leaf_size, inner_size))
    if len(b) < _NODE.size:
        raise BigWigError(f"truncated file: no tree node at offset {offset}")
    is_leaf, _r, n = _NODE.unpack_from(b)
    size = n * (leaf_size if is_leaf else inner_size)
    if len(b) < _NODE.size + size:
        return bool(is_leaf), n, read_exact(f, offset + _NODE.size, size)
    return bool(is_leaf), n, b[_NODE.size:_NODE.size + size]


def read_chroms(f, header: Header) -> list[tuple[str, int, int]]:
    """Every (name, chrom_id, size) in the chromosome B+ tree."""
    b = read_exact(f, header.chrom_tree_offset, _BPT_HEADER.size)
    magic, block, key_size, val_size, count, _ = _BPT_HEADER.unpack(b)
    if magic != CHROM_TREE_MAGIC:
        raise BigWigError("bad chromosome tree magic number")
    if val_size != 8:
        raise BigWigError(f"unexpected chromosome tree value size {val_size}")
    out: list[tuple[str, int, int]] = []
    item = key_size + 8
    stack = [header.chrom_tree_offset + _BPT_HEADER.size]
    seen: set[int] = set()
    while stack:
        off = stack.pop()
        _visit(seen, off, "chromosome tree")
        is_leaf, n, body = _read_node(f, off, item, item, block)
        if is_leaf:
            for i in range(n):
                p = i * item
                name = body[p:p + key_size].rstrip(b"\0").decode("utf-8", "replace")
                cid, size = struct.unpack_from("<II", body, p + key_size)
                out.append((name, cid, size))
        else:
            kids = [struct.unpack_from("<Q", body, i * item + key_size)[0] for i in range(n)]
            stack.extend(reversed(kids))
    if len(out) != count:
        raise BigWigError(f"chromosome tree lists {len(out)} of {count} chromosomes")
    return out


def _node_mask(items: np.ndarray, keep_ids: np.ndarray | None,
               bounds: tuple[int | None, int | None] | None) -> np.ndarray:
    """Which R-tree items (nodes or blocks) may hold wanted rows: some kept
    chromosome id within [sc, ec], and — for items on one chromosome — an
    overlap with rows having end0 >= lo and start0 < hi."""
    sc = items["sc"].astype(np.int64)
    ec = items["ec"].astype(np.int64)
    mask = np.ones(len(items), dtype=bool)
    if keep_ids is not None:
        k = np.sort(keep_ids)
        mask &= np.searchsorted(k, ec, "right") > np.searchsorted(k, sc, "left")
    if bounds is not None:
        lo, hi = bounds
        single = sc == ec
        ok = np.ones(len(items), dtype=bool)
        if lo is not None:
            ok &= items["eb"].astype(np.int64) >= lo
        if hi is not None:
            ok &= items["sb"].astype(np.int64) < hi
        mask &= ~single | ok
    return mask


def read_index_leaves(f, header: Header, keep_ids: np.ndarray | None = None,
                      bounds: tuple[int | None, int | None] | None = None) -> np.ndarray:
    """R-tree leaf items (block bounds, file offset, size) in file order.
    With ``keep_ids`` / ``bounds`` the traversal skips subtrees that cannot
    hold wanted rows, so a region query reads O(log n) index nodes instead of
    every leaf."""
    b = read_exact(f, header.full_index_offset, _RT_HEADER.size)
    magic, block = struct.unpack_from("<II", b)
    if magic != RTREE_MAGIC:
        raise BigWigError("bad R-tree magic number")
    leaves = []
    stack = [header.full_index_offset + _RT_HEADER.size]
    seen: set[int] = set()
    prune = keep_ids is not None or bounds is not None
    while stack:
        off = stack.pop()
        _visit(seen, off, "R-tree")
        is_leaf, n, body = _read_node(f, off, RT_LEAF.itemsize, RT_INNER.itemsize, block)
        if is_leaf:
            items = np.frombuffer(body, dtype=RT_LEAF)
            leaves.append(items[_node_mask(items, keep_ids, bounds)] if prune else items)
        else:
            inner = np.frombuffer(body, dtype=RT_INNER)
            if prune:
                inner = inner[_node_mask(inner, keep_ids, bounds)]
            stack.extend(int(x) for x in inner["off"][::-1])
    if not leaves:
        return np.zeros(0, dtype=RT_LEAF)
    items = np.concatenate(leaves)
    return items[np.argsort(items["off"], kind="stable")]


_ITEM_SIZE = {SECTION_BEDGRAPH: 12, SECTION_VARSTEP: 8, SECTION_FIXEDSTEP: 4}


def section_size(header: bytes) -> int:
    """Byte length of an uncompressed data block from its 24-byte header."""
    if len(header) < SECTION_HEADER_SIZE:
        raise BigWigError("data block shorter than its header")
    _cid, _cs, _ce, _step, _span, kind, _r, n = _SECTION.unpack_from(header)
    if kind not in _ITEM_SIZE:
        raise BigWigError(f"unknown data block type {kind}")
    return SECTION_HEADER_SIZE + n * _ITEM_SIZE[kind]


def decode_section(raw: bytes, compressed: bool):
    """One data block -> (chrom_id, start0 u32[], end0 u32[], score f32[])."""
    buf = zlib.decompress(raw) if compressed else raw
    if len(buf) < SECTION_HEADER_SIZE:
        raise BigWigError("data block shorter than its header")
    cid, cstart, _cend, step, span, kind, _r, n = _SECTION.unpack_from(buf)
    body = memoryview(buf)[SECTION_HEADER_SIZE:]
    if kind == SECTION_BEDGRAPH:
        a = np.frombuffer(body, dtype=BEDGRAPH_ITEM, count=n)
        return cid, a["s"], a["e"], a["v"]
    if kind == SECTION_VARSTEP:
        a = np.frombuffer(body, dtype=VARSTEP_ITEM, count=n)
        s = a["s"]
        return cid, s, s + np.uint32(span), a["v"]
    if kind == SECTION_FIXEDSTEP:
        v = np.frombuffer(body, dtype="<f4", count=n)
        s = (np.uint32(cstart) + np.arange(n, dtype=np.uint32) * np.uint32(step)).astype(np.uint32)
        return cid, s, s + np.uint32(span), v
    raise BigWigError(f"unknown data block type {kind}")
