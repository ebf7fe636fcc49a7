"""Rows of a fit in files of the executors' own folders, and its passes over them.

Where a fit has several tasks and few distinct weights, its rows are packed once, some tens of bytes each: bins of wide features are bytes,
tags are bits, a weight is a number. A task keeps them in a file beside Spark's own blocks and maps it in each pass, so that no row goes
through a socket again. The fit of a round stands in a second file, which the first pass of the round makes from that of the round
before. Both are caches: the kept handles have the files' names; where a file isn't found, the driver has the pass over
that part done from the stored rows and all trees, and a lost executor's parts are packed anew.

The pass for leaf values takes along the root sums of the next round, as ``boosting`` does for blocks.

Sums of a level are whole numbers, counts by weight and side of the fit, so they are the same however rows are dealt out. One count of a
feature serves several quantiles: a row's code says for each of them which node it is in, and on which side of the fit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from types import SimpleNamespace

import numpy as np

CHUNK_ROWS = 65_536  # rows of a task that are worked on at once
MOST_KINDS = 4  # distinct weights
_CODES = 512  # states of several quantiles and weights that are counted at once
_NEAR = 5.0  # standard deviations of a chunk's quantile within which the other chunks' rows are looked at


def kernels(base: SimpleNamespace, wide: int, n_bins: int, n_tags: int, kinds: list[float], n_q: int) -> SimpleNamespace:
    """The work of one task. Made inside a function, so that workers need not have this package."""
    import glob
    import mmap
    import os
    import tempfile
    import uuid

    nodes, advanced, weights, n_kinds, chunk_rows, most_codes, near = base.nodes, base.advanced, np.array(kinds), len(kinds), CHUNK_ROWS, _CODES, _NEAR

    class Bins:
        """Bins by feature, as ``nodes`` reads them."""

        def __init__(self, dense: np.ndarray, bits: np.ndarray, n: int):
            self.dense, self.bits, self.shape = dense, bits, (len(dense) + len(bits), n)

        def __getitem__(self, feature: int) -> np.ndarray:
            if feature < len(self.dense):
                return self.dense[feature]
            return np.unpackbits(self.bits[feature - len(self.dense)].view(np.uint8), count=self.shape[1], bitorder="little")

    def bits_of(flags: np.ndarray) -> np.ndarray:
        """Rows of flags as whole words of bits."""
        n = flags.shape[-1]
        out = np.zeros((*flags.shape[:-1], -(-n // 64) * 8), np.uint8)
        out[..., : -(-n // 8)] = np.packbits(flags, axis=-1, bitorder="little")
        return out.view(np.uint64)

    def arrays_of(blocks: Iterator[dict]) -> Iterator[tuple[int, list[np.ndarray]]]:
        """Rows and arrays of a chunk: hash, target, tags, bins, kind of weight."""

        def packed(held: list[dict]) -> tuple[int, list[np.ndarray]]:
            row_hash, delta, weight = (np.concatenate([b[k] for b in held]) for k in ("row_hash", "delta", "weight"))
            bins = np.concatenate([b["bins"] for b in held], axis=1)
            return len(delta), [row_hash, delta, bits_of(bins[wide:]), bins[:wide], np.searchsorted(weights, weight).astype(np.uint8)]

        held, n = [], 0
        for block in blocks:
            held.append(block)
            n += len(block["delta"])
            if n >= chunk_rows:
                yield packed(held)
                held, n = [], 0
        if n:
            yield packed(held)

    def chunk(n: int, arrays: list[np.ndarray]) -> dict:
        row_hash, delta, bits, dense, kind = arrays
        return {"row_hash": row_hash, "delta": delta, "bins": Bins(dense, bits, n), "kind": kind}

    def store(index: int, blocks: Iterator[dict], name: str) -> tuple[int, str, list[int]]:
        """Writes a part's chunks; its handle is number, path and rows of each chunk."""
        folders = os.environ.get("SPARK_LOCAL_DIRS", tempfile.gettempdir()).split(",")
        path, sizes = os.path.join(folders[index % len(folders)], f"{name}-{index}"), []
        with open(own := f"{path}-{uuid.uuid4().hex}", "wb") as out:
            for n, arrays in arrays_of(blocks):
                written = sum(out.write(np.ascontiguousarray(a).data.cast("B") if a.size else b"") for a in arrays)
                out.write(bytes(-written % 8))
                sizes.append(n)
        os.replace(own, path)
        return index, path, sizes

    def fits_of(path: str) -> dict[int, str]:
        """The stored fits by the rounds in them."""
        found = [(f.rpartition(".fit")[2], f) for f in glob.glob(f"{glob.escape(path)}.fit*")]
        return {int(k): f for k, f in found if k.isdigit()}

    def opened(handle: tuple[int, str, list[int]], start: list[float], done: int, trees: Callable[[int], list]) -> Iterator[tuple[dict, np.ndarray]]:
        """Chunks with the fit after ``done`` rounds, which is stored; ``trees`` gives those from a round on."""

        def mapped(name: str) -> mmap.mmap:
            with open(name, "rb") as file:
                return mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)

        _, path, sizes = handle
        if not sizes:
            return
        stored = fits_of(path)
        since = max((k for k in stored if k <= done), default=0)
        rows, fits, at, fit_at = mapped(path), since and mapped(stored[since]), 0, 0
        later = trees(since) if since < done else []
        out = open(own := f"{path}.fit{done}-{uuid.uuid4().hex}", "wb") if later else None
        for n in sizes:
            arrays = []
            for kind, shape in ((np.int64, (n,)), (np.float64, (n,)), (np.uint64, (n_tags, -(-n // 64))), (np.uint8, (wide, n)), (np.uint8, (n,))):
                held = int(np.prod(shape))
                arrays.append(np.frombuffer(rows, kind, held, at).reshape(shape) if held else np.zeros(shape, kind))
                at += held * np.dtype(kind).itemsize
            at += -at % 8
            block = chunk(n, arrays)
            fit = np.frombuffer(fits, np.float64, n_q * n, fit_at).reshape(n_q, n) if since else np.repeat(np.array(start)[:, None], n, axis=1)
            fit_at += 8 * n_q * n
            if later:
                fit = advanced(block, fit, later)
                out.write(fit.data.cast("B"))
            yield block, fit
        if later:
            out.close()
            os.replace(own, f"{path}.fit{done}")
            for k, f in stored.items():
                if k < done - 1:
                    os.remove(f)

    def removed(handle: tuple[int, str, list[int]]) -> None:
        for f in [handle[1], *glob.glob(f"{glob.escape(handle[1])}.fit*")]:
            if os.path.exists(f):
                os.remove(f)

    def level(chunks: Iterator[tuple[dict, np.ndarray]], bagged: Callable[[dict], np.ndarray], trees: list[dict]) -> np.ndarray:
        """``[quantile, feature, node, bin, (kind of weight, side of the fit)]``, the number of rows of the left nodes of a level, or of the root."""
        number = trees[0]["levels"]
        first, n_nodes = 2**number - 1, max(1, 2 ** (number - 1))
        states = 1 + 2 * n_nodes  # of a quantile: not counted, or node and side
        together = max(1, int(np.log(most_codes / n_kinds) / np.log(states) + 1e-9))
        groups = [range(q, min(q + together, n_q)) for q in range(0, n_q, together)]
        cells = [states ** len(g) * n_kinds * n_bins for g in groups]
        dense = [np.zeros((wide, c), np.int64) for c in cells]
        total, ones = np.zeros((n_q, states * n_kinds), np.int64), np.zeros((n_q, n_tags, states * n_kinds), np.int64)
        for block, fit in chunks:
            bag, bins, kind, state = bagged(block), block["bins"], block["kind"], []
            for q, tree in enumerate(trees):
                here, own = bag, np.uint8(1) + (block["delta"] <= fit[q])
                if number:
                    at = nodes(bins, tree) - first
                    here = bag & (at >= 0) & (at & 1 == 0)  # left children
                    own = own + at
                state.append((own * here).astype(np.uint16))
                coded = state[q] * np.uint16(n_kinds) + kind
                total[q] += np.bincount(coded, None, states * n_kinds)
                for code in range(n_kinds, states * n_kinds) if n_tags else ():
                    ones[q, :, code] += np.bitwise_count(bins.bits & bits_of(coded == code)).sum(axis=1, dtype=np.int64)
            buffer = np.empty(len(kind), np.int64)
            for group, of_group, n_cells in zip(groups, dense, cells):
                code = np.zeros(len(kind), np.int64)
                for q in group:
                    code = code * states + state[q]
                code = (code * n_kinds + kind) * n_bins
                for feature in range(wide):
                    np.add(code, bins.dense[feature], out=buffer)
                    of_group[feature] += np.bincount(buffer, None, n_cells)
        out = []
        for group, of_group in zip(groups, dense):
            shaped = of_group.reshape(wide, *[states] * len(group), n_kinds, n_bins)
            for i, q in enumerate(group):
                own = shaped.sum(axis=tuple(1 + k for k in range(len(group)) if k != i))[:, 1:]
                own = own.reshape(wide, n_nodes, 2, n_kinds, n_bins).transpose(0, 1, 4, 3, 2)
                of_tags, whole = (a[..., n_kinds:].reshape(-1, n_nodes, 2, n_kinds).transpose(0, 1, 3, 2) for a in (ones[q], total[q]))
                out += [own.ravel(), np.stack([whole - of_tags, of_tags], axis=2).ravel(), whole.ravel()]
        return np.concatenate(out)

    def windows(chunks: Iterator[tuple[dict, np.ndarray]], bagged: Callable[[dict], np.ndarray], trees: list[dict], seats: list[np.ndarray], shares: list[float], spread: float, slack: float) -> list[tuple]:
        """For each quantile: rows below by ``[leaf, kind]``, all rows so, ``[leaf, (first, last)]``, and leaf, value and rows by kind of the residuals around the quantile.

        Rows that are left out lie below ``first`` or above ``last``; these are infinite where none is. Equal residuals are one value.
        """
        size = 1 + max(int(s[-1]) for s in seats)
        below, every = (np.zeros((n_q, size * n_kinds), np.int64) for _ in range(2))
        bounds, kept = None, [[] for _ in range(n_q)]

        def around(ends: np.ndarray, residual: np.ndarray, kind: np.ndarray, under: np.ndarray, whole: np.ndarray, share: float, leaf: int, wanted: float) -> tuple[int, int]:
            """From where to where the sorted rows of a leaf are within some standard deviations of its quantile."""
            first, last = int(ends[leaf]), int(ends[leaf + 1])
            upto = under[leaf] @ weights + np.cumsum(weights[kind[first:last]])
            middle = int(np.searchsorted(upto, whole[leaf] @ weights * share * slack))
            half = int(wanted * np.sqrt(whole[leaf].sum() * share * (1 - share))) + 2
            low, high = min(first + max(middle - half, 0), last), min(first + middle + half, last)
            if low < high:  # with all that equal the first and the last one
                low, high = (first + int(np.searchsorted(residual[first:last], residual[i], side)) for i, side in ((low, "left"), (high - 1, "right")))
            return low, high

        def ordered(at: np.ndarray, residual: np.ndarray, kind: np.ndarray) -> tuple:
            order = np.argsort(residual)
            order = order[np.argsort(at[order], kind="stable")]
            at = at[order]
            return at, residual[order], kind[order], np.searchsorted(at, np.arange(size + 1))

        for block, fit in chunks:
            bag, found = bagged(block), []
            kind = block["kind"][bag]
            for q, tree in enumerate(trees):
                at = seats[q].astype(np.uint8 if size < 256 else np.int64)[nodes(block["bins"], tree)[bag]]
                found.append((at, (block["delta"] - fit[q])[bag], at.astype(np.uint16) * np.uint16(n_kinds) + kind))
            if bounds is None:  # the task's first rows tell where the quantiles are about
                bounds = np.tile(np.array([-np.inf, np.inf])[:, None, None], (1, n_q, size))
                for q, (at, residual, _) in enumerate(found):
                    whole, none = np.bincount(found[q][2], None, size * n_kinds).reshape(size, n_kinds), np.zeros((size, n_kinds))
                    at, residual, kinds_of, ends = ordered(at, residual, kind)
                    for leaf in np.unique(at).tolist():
                        low, high = around(ends, residual, kinds_of, none, whole, shares[q], leaf, near)
                        if low > ends[leaf]:
                            bounds[0, q, leaf] = residual[low]
                        if high < ends[leaf + 1]:
                            bounds[1, q, leaf] = residual[high - 1]
            for q, (at, residual, place) in enumerate(found):
                under = residual < bounds[0, q][at]
                rows = np.flatnonzero(~under & (residual <= bounds[1, q][at]))
                every[q] += np.bincount(place, None, size * n_kinds)
                below[q] += np.bincount(place[under], None, size * n_kinds)
                kept[q].append((at[rows], residual[rows], kind[rows]))
        out = []
        for q, share in enumerate(shares if bounds is not None else ()):
            under, whole = (a[q].reshape(size, n_kinds) for a in (below, every))
            at, residual, kind, ends = ordered(*(np.concatenate([k[i] for k in kept[q]]) for i in range(3)))
            edges, rows, before = np.tile([-np.inf, np.inf], (size, 1)), [], under.copy()
            for leaf in range(size):
                low, high = around(ends, residual, kind, under, whole, share, leaf, spread)
                before[leaf] += np.bincount(kind[ends[leaf] : low], None, n_kinds)
                if before[leaf].any():
                    edges[leaf, 0] = bounds[0, q, leaf] if low == ends[leaf] else residual[low] if low < high else np.inf
                if whole[leaf].sum() > before[leaf].sum() + high - low:
                    edges[leaf, 1] = bounds[1, q, leaf] if high == ends[leaf + 1] else residual[high - 1] if low < high else -np.inf
                rows.append(np.arange(low, high))
            rows = np.concatenate(rows)
            at, residual, kind = at[rows], residual[rows], kind[rows]
            new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (residual[1:] != residual[:-1])])) if len(rows) else rows
            alike = np.stack([np.add.reduceat((kind == k).astype(np.int64), new) if len(rows) else rows for k in range(n_kinds)], axis=-1)
            out.append((before, whole, edges, at[new], residual[new], alike))
        return out

    def ahead(chunks: Callable[[], Iterator], found: list[tuple], next_bag: Callable[[dict], np.ndarray], trees: list[dict], seats: list[np.ndarray], rate: float, roots: list[dict]) -> tuple[np.ndarray, list[list[tuple]]]:
        """The root sums of the next round as far as the windows tell on which side of the fit a row will be, and the rows they leave open.

        An open row, by quantile: node, target, fit, kind, bins and tags. It counts as above the fit in the sums.
        """
        low, high = ([rate * f[2][s, k] for f, s in zip(found, seats)] for k in (0, 1))
        left_open = [[] for _ in range(n_q)]

        def moved() -> Iterator[tuple[dict, np.ndarray]]:
            for block, fit in chunks():
                bag, delta, bins, least = next_bag(block), block["delta"], block["bins"], np.empty_like(fit)
                for q, tree in enumerate(trees):
                    at = nodes(bins, tree)
                    least[q] = fit[q] + low[q][at]
                    rows = np.flatnonzero(bag & (delta > least[q]) & (delta <= fit[q] + high[q][at]))
                    if len(rows):
                        tags = np.stack([bins[f][rows] for f in range(wide, wide + n_tags)]) if n_tags else np.zeros((0, len(rows)), np.uint8)
                        left_open[q].append((at[rows], delta[rows], fit[q, rows], block["kind"][rows], bins.dense[:, rows], tags))
                yield block, least

        return level(moved(), next_bag, roots), left_open

    def settled(sums: np.ndarray, left_open: list[tuple], step: np.ndarray) -> None:
        """Counts a quantile's open rows where they lie, now that it is known what the nodes add to the fit."""
        if not left_open:
            return
        at, delta, fit, kind, dense, tags = (np.concatenate([r[k] for r in left_open], axis=-1) for k in range(6))
        below, m = delta <= fit + step[at], 2 * n_kinds
        of_bins, of_tags = sums[: wide * n_bins * m].reshape(wide, n_bins, m), sums[wide * n_bins * m : -m].reshape(n_tags, 2, m)
        kind, dense, tags = kind[below].astype(np.int64), dense[:, below], tags[:, below]
        for side, n in ((1, 1), (0, -1)):
            np.add.at(of_bins, (np.arange(wide)[:, None], dense, 2 * kind + side), n)
            np.add.at(of_tags, (np.arange(n_tags)[:, None], tags, 2 * kind + side), n)
            np.add.at(sums[-m:], 2 * kind + side, n)

    return SimpleNamespace(ahead=ahead, settled=settled, arrays_of=arrays_of, chunk=chunk, store=store, opened=opened, removed=removed, level=level, windows=windows, weights=weights)
