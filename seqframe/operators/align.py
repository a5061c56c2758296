"""Pairwise alignment as a job over a table of pairs, and the joins that find the pairs.

The dynamic program (Gotoh's affine gaps, local or global) runs over all pairs of an Arrow
batch at once, row by row: numpy works on all columns of all pairs. A gap of k letters
costs open + (k - 1) * ext. Coordinates are 0-based, the top sequence is the reference. Letters score by match and mismatch, or by a ``Matrix``.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqframe.functions import sequence as S
from seqframe.sources.paths import shared_folder, spread

#: Cells whose moves a task holds at once, one byte each. A pair with more keeps rows at intervals and makes the moves between them again.
CELLS = 24_000_000
RESULT = (
    "score int, identical int, alnlen int, identity double, nogap_identity double, noterm_identity double, cov_ref double, cov_read double,"
    " ref_begin int, ref_end int, read_begin int, read_end int, gaps_ref int, gaps_read int, gaplen_ref int, gaplen_read int, top string, bottom string"
)
# Match, mismatch, gap opening and gap extension of the kinds of work.
SCORES = {"reads": (10, -9, -29, -3), "consensus": (11, -10, -39, -4), "sites": (10, -9, -11, -3), "bait": (10, -9, -19, -3), "stem": (7, -7, -5, -3), "subsequence": (5, -5, -8, -4), "global": (5, -3, -13, -1)}
_LOW = -(1 << 28)


@dataclass(frozen=True)
class Matrix:
    """Scores by pair of letters, 256 by 256, and gap scores."""

    table: np.ndarray
    gap_open: int
    gap_ext: int


def read_matrix(text: str, gap_open: int = -11, gap_ext: int = -1) -> Matrix:
    """A substitution matrix in the usual text form: comments after #, a line of letters, then a letter and its scores a line.

    Letters that it doesn't have score as its ``*``, if there is one, else as its least score.
    """
    rows = [line.split() for line in text.splitlines() if line.strip() and not line.lstrip().startswith("#")]
    if not rows or any(len(r) != len(rows[0]) + 1 for r in rows[1:]):
        raise ValueError("not a matrix: every line after the first has a letter and one score for each letter of the first")
    known = {(r[0].upper(), c.upper()): int(v) for r in rows[1:] for c, v in zip(rows[0], r[1:], strict=True)}
    rest = min(known.values()) if ("*", "*") not in known else min(v for (r, c), v in known.items() if "*" in (r, c))
    table = np.full((256, 256), rest, np.int32)
    for (r, c), v in known.items():
        table[ord(r), ord(c)] = v
    return Matrix(table, gap_open, gap_ext)


def group_matrix(groups: str = "AGPST C DENQ FWY HKR ILMV", same: int = 5, near: int = 1, other: int = -3, gap_open: int = -11, gap_ext: int = -1) -> Matrix:
    """A matrix by rule: equal letters, letters of one group (amino acids of like chemistry), all others."""
    table = np.full((256, 256), other, np.int32)
    for group in groups.split():
        at = np.frombuffer(group.encode(), np.uint8)
        table[np.ix_(at, at)] = near
    np.fill_diagonal(table, same)
    table[ord("X"), :] = table[:, ord("X")] = 0
    return Matrix(table, gap_open, gap_ext)


def _gap_scores(scores: tuple[int, int, int, int] | Matrix) -> tuple[int, int]:
    gap_open, gap_ext = (scores.gap_open, scores.gap_ext) if isinstance(scores, Matrix) else scores[2:]
    if gap_open > gap_ext or gap_ext > 0:
        raise ValueError("opening a gap must cost at least as much as extending it")
    return gap_open, gap_ext


class _Rows:
    """Rows of the dynamic program of a batch of pairs: one numpy operation a row works on all columns of all pairs.

    A gap along a row is the greatest of all its openings before, a running maximum, as opening costs no less than extending.
    """

    def __init__(self, tops: list[str], bottoms: list[str], mode: str, scores: tuple[int, int, int, int] | Matrix):
        self.local, self.n = mode == "local", len(tops)
        self.len1, self.len2 = np.array([len(t) for t in tops]), np.array([len(b) for b in bottoms])
        self.w1, self.w2 = int(self.len1.max(initial=0)), int(self.len2.max(initial=0))
        self.table = scores.table if isinstance(scores, Matrix) else None
        self.open, self.ext = _gap_scores(scores)
        self.match, self.mismatch = (0, 0) if isinstance(scores, Matrix) else scores[:2]
        self.x, self.y = self._codes(tops, self.w1, 1), self._codes(bottoms, self.w2, 2)
        self.steps = np.arange(self.w2 + 1, dtype=np.int32) * np.int32(self.ext)
        self.valid = np.arange(1, self.w2 + 1) <= self.len2[:, None]

    def _codes(self, texts: list[str], width: int, pad: int) -> np.ndarray:
        out = np.full((self.n, width), pad, np.uint8)
        for k, t in enumerate(texts):
            out[k, : len(t)] = np.frombuffer(t.upper().encode("latin-1", "replace")[: len(t)], np.uint8)
        return out

    def edge(self, k: int) -> int:
        return 0 if self.local or not k else self.open + (k - 1) * self.ext

    def first(self) -> tuple[np.ndarray, np.ndarray]:
        """Scores of row 0, and of gaps that go down from it."""
        row = np.array([self.edge(j) for j in range(self.w2 + 1)], np.int32)
        return np.repeat(row[None], self.n, axis=0), np.full((self.n, self.w2 + 1), _LOW, np.int32)

    def row(self, i: int, h: np.ndarray, up: np.ndarray, moves: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Row i from the one before; moves gets its cells: bits 0-1 come from (0 stop, 1 diagonal, 2 up, 3 left), bit 2 up extends, bit 3 left extends."""
        letter = self.x[:, i - 1 : i]
        worth = self.table[letter, self.y] if self.table is not None else np.where(letter == self.y, np.int32(self.match), np.int32(self.mismatch))
        opened, longer = h[:, 1:] + np.int32(self.open), up[:, 1:] + np.int32(self.ext)
        down = np.maximum(opened, longer)
        diagonal = h[:, :-1] + worth
        own = np.full((self.n, self.w2 + 1), self.edge(i), np.int32)
        np.maximum(diagonal, down, out=own[:, 1:])
        if self.local:
            np.maximum(own, 0, out=own)
        left = np.full((self.n, self.w2 + 1), _LOW, np.int32)
        left[:, 1:] = np.maximum.accumulate(own - self.steps, axis=1)[:, :-1] + (self.steps[1:] + np.int32(self.open - self.ext))
        new = np.maximum(own, left)
        if moves is not None:
            made = np.where(new[:, 1:] == diagonal, 1, np.where(new[:, 1:] == down, 2, 3)).astype(np.uint8)
            if self.local:
                made[new[:, 1:] <= 0] = 0
            made |= (longer > opened).astype(np.uint8) << 2
            made |= (left[:, :-1] + np.int32(self.ext) > new[:, :-1] + np.int32(self.open)).astype(np.uint8) << 3
            moves[:, 1:] = made
            moves[:, 0] = 0 if self.local else 2 if i == 1 else 2 | 4
        extended = np.empty_like(up)
        extended[:, 0], extended[:, 1:] = _LOW, down
        return new, extended

    def edge_moves(self) -> np.ndarray:
        out = np.zeros((self.n, self.w2 + 1), np.uint8)
        if not self.local:
            out[:, 1:] = 3 | 8
            out[:, 1:2] = 3
        return out


class _Best:
    """The best end of each pair so far: in local mode the greatest score, the first of equals by row, then column; else the last cell."""

    def __init__(self, rows: _Rows, h: np.ndarray):
        self.rows, n = rows, rows.n
        self.score, self.i, self.j = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        if not rows.local:
            self.take(0, h)

    def take(self, i: int, h: np.ndarray) -> None:
        r = self.rows
        if r.local:
            if not r.w2:
                return
            valid = np.where(r.valid, h[:, 1:], 0)
            j = valid.argmax(axis=1)
            top = valid[np.arange(r.n), j]
            better = (top > self.score) & (i <= r.len1)
            self.score[better], self.i[better], self.j[better] = top[better], i, j[better] + 1
        else:
            here = np.flatnonzero(r.len1 == i)
            self.score[here], self.i[here], self.j[here] = h[here, r.len2[here]], i, r.len2[here]


def align_batch(tops: list[str], bottoms: list[str], mode: str = "local", scores: tuple[int, int, int, int] | Matrix = SCORES["reads"]) -> list[dict]:
    """Best alignment of each pair (first of equals by the order diagonal, gap in bottom, gap in top)."""
    made = align_table(tops, bottoms, mode, scores)
    return [dict(zip(made, values, strict=True)) for values in zip(*(c.tolist() if isinstance(c, np.ndarray) else c for c in made.values()), strict=True)]


def align_table(tops: list[str], bottoms: list[str], mode: str = "local", scores: tuple[int, int, int, int] | Matrix = SCORES["reads"]) -> dict[str, np.ndarray | list[str]]:
    """The columns of RESULT of all pairs. Local alignments that need no gap are settled without the full program (``_ungapped``, ``_reached``)."""
    names = [w.split()[0] for w in RESULT.split(",")]
    _gap_scores(scores)
    if not tops:
        return {c: [] for c in names}
    if not all(t.isascii() for t in tops) or not all(b.isascii() for b in bottoms):
        rows = _program(tops, bottoms, mode, scores)
        return {c: [r[c] for r in rows] for c in names}
    x, y = _bytes(tops), _bytes(bottoms)
    settled = np.zeros(len(tops), bool)
    parts = []
    if mode == "local" and not isinstance(scores, Matrix) and scores[0] > 0 > scores[1]:
        settled, score, i, j, length = _ungapped(tops, bottoms, x, y, scores)
        open_ = np.flatnonzero(~settled & (score > 0))
        if len(open_) and _small(x, y, scores):
            # where the full program ends in the same cell with the same score, it goes back along the same diagonal, which it prefers
            full = _reached(x[open_], y[open_], scores)
            settled[open_] = (full[0] == score[open_]) & (full[1] == i[open_]) & (full[2] == j[open_])
        at = np.flatnonzero(settled)
        moves = (np.arange(length[at].max(initial=0)) < length[at, None]).astype(np.uint8)
        parts.append((at, _measured(x[at], y[at], *_lengths(tops, bottoms, at), moves, length[at], score[at], (i - length)[at], i[at], (j - length)[at], j[at])))
    rest = np.flatnonzero(~settled)
    if len(rest):
        made = _program([tops[k] for k in rest], [bottoms[k] for k in rest], mode, scores, (x[rest], y[rest]))
        parts.append((rest, made if isinstance(made, dict) else {c: [r[c] for r in made] for c in names}))
    if len(parts) == 1 or not len(parts[0][0]):
        return parts[-1][1]
    if not len(rest):
        return parts[0][1]
    back = np.argsort(np.concatenate([at for at, _ in parts]), kind="stable")
    return {c: np.concatenate([np.asarray(m[c], object if c in ("top", "bottom") else None) for _, m in parts])[back] for c in names}


def _bytes(texts: list[str]) -> np.ndarray:
    """ASCII texts as rows of letters, filled up with 0."""
    width = max(map(len, texts))
    return np.array(texts, f"S{max(width, 1)}").view(np.uint8).reshape(len(texts), -1)[:, :width]


def _upper(codes: np.ndarray) -> np.ndarray:
    return np.where((codes >= 97) & (codes <= 122), codes - 32, codes).astype(np.uint8)


def _lengths(tops: list[str], bottoms: list[str], at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.array([len(tops[k]) for k in at], np.int64), np.array([len(bottoms[k]) for k in at], np.int64)


def _ungapped(tops: list[str], bottoms: list[str], x: np.ndarray, y: np.ndarray, scores: tuple[int, int, int, int]) -> tuple[np.ndarray, ...]:
    """(settled, score, i, j, length) of the best local alignment without gaps: its score, ends and columns.

    An alignment with a gap scores at most all letters of the shorter text and the opening of one gap. A pair whose ungapped score
    is over that is settled: no path with a gap reaches the score, so the full program takes the same cells.
    """
    match, mismatch, gap_open, _ = scores
    (len1, len2), n = _lengths(tops, bottoms, np.arange(len(tops))), len(tops)
    w1, w2 = x.shape[1], y.shape[1]
    if not w1 or not w2 or match * min(w1, w2) > 32_000 or w1 > 65_000 or mismatch < -32_000:
        none = np.zeros(n, np.int64)
        return np.zeros(n, bool), none, none, none, none
    # what fills up the texts agrees with nothing
    x, y = np.where(np.arange(w1) < len1[:, None], _upper(x), 1).astype(np.uint8), np.where(np.arange(w2) < len2[:, None], _upper(y), 2).astype(np.uint8)
    h, best = np.zeros((n, w2 + 1), np.int16), np.zeros((n, w2), np.int32)
    step, low, none = np.int16(match - mismatch), np.int16(mismatch), np.zeros((n, w2), np.int16)
    for i in range(w1):
        new = (x[:, i : i + 1] == y).astype(np.int16)
        new *= step
        new += low
        new += h[:, :-1]
        np.maximum(new, none, out=h[:, 1:])
        # the greatest score, then the first row; the first column of equals is taken below
        np.maximum(best, (h[:, 1:].astype(np.int32) << 16) | np.int32(65_535 - i), out=best)
    j = best.argmax(axis=1)
    top = best[np.arange(n), j]
    score, i, j = (top >> 16).astype(np.int64), 65_535 - (top & 65_535).astype(np.int64) + 1, j.astype(np.int64) + 1
    settled = (score > 0) & (score > match * np.minimum(len1, len2) + gap_open)
    # back along the diagonal to where the score is used up
    span = np.arange(min(w1, w2))
    a, b = i[:, None] - 1 - span, j[:, None] - 1 - span
    inside = (a >= 0) & (b >= 0)
    same = np.take_along_axis(x, np.maximum(a, 0), 1) == np.take_along_axis(y, np.maximum(b, 0), 1)
    used = np.cumsum(np.where(same, match, mismatch), axis=1)
    length = ((used == score[:, None]) & inside).argmax(axis=1) + 1
    return settled, score, i, j, length


def best_scores(tops: list[str], bottoms: list[str], scores: tuple[int, int, int, int]) -> np.ndarray:
    """The score of the best local alignment of each pair."""
    if not tops:
        return np.zeros(0, np.int64)
    if all(t.isascii() for t in tops) and all(b.isascii() for b in bottoms):
        x, y = _bytes(tops), _bytes(bottoms)
        if _small(x, y, scores):
            return _reached(x, y, scores)[0]
    return np.asarray(align_table(tops, bottoms, "local", scores)["score"], np.int64)


def _small(x: np.ndarray, y: np.ndarray, scores: tuple[int, int, int, int] | Matrix) -> bool:
    """Whether ``_reached`` can score pairs of these widths with 16 bits."""
    if isinstance(scores, Matrix) or not scores[0] > 0 > max(scores[1], scores[2]):
        return False
    match, mismatch, gap_open, gap_ext = scores
    return match * min(x.shape[1], y.shape[1]) - gap_ext * (y.shape[1] + 1) - gap_open - mismatch < 16_000


def _reached(x: np.ndarray, y: np.ndarray, scores: tuple[int, int, int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(score, i, j) of the best end of each local alignment, as ``_Best`` has them, by 16-bit rows without moves. Texts are filled up with 0."""
    made = [_reached_part(x[k : k + PAIRS], y[k : k + PAIRS], scores) for k in range(0, len(x), PAIRS)]
    return tuple(np.concatenate(c) for c in zip(*made, strict=True)) if made else (np.zeros(0, np.int64),) * 3


#: Pairs that ``_reached`` works on at once, so that their rows stay in the cache.
PAIRS = 2048


def _reached_part(x: np.ndarray, y: np.ndarray, scores: tuple[int, int, int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    match, mismatch, gap_open, gap_ext = (np.int16(v) for v in scores)
    n, w2 = y.shape
    # what fills up the texts agrees with nothing, and so no cell there has the best score; one line a letter, as all operations go over pairs
    x, y = np.ascontiguousarray(np.where(x == 0, 1, _upper(x)).astype(np.uint8).T), np.ascontiguousarray(np.where(y == 0, 2, _upper(y)).astype(np.uint8).T)
    score, at_i, at_j = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    h, up = np.zeros((w2 + 1, n), np.int16), np.full((w2, n), -16_000, np.int16)
    new, left = np.empty((w2, n), np.int16), np.empty((w2, n), np.int16)
    none = np.zeros((w2, n), np.int16)  # numpy takes the maximum with an array ten times as fast as with a number
    lines, steps = list(left), (np.arange(w2, dtype=np.int16) * gap_ext)[:, None]
    for i in range(len(x) if w2 else 0):
        up += gap_ext
        np.maximum(up, np.add(h[1:], gap_open, out=left), out=up)
        np.multiply(y == x[i], match - mismatch, out=new, dtype=np.int16, casting="unsafe")
        new += mismatch
        new += h[:-1]
        np.maximum(new, up, out=new)
        np.maximum(new, none, out=new)
        # gaps along the row: the greatest of all their openings before
        np.subtract(new, steps, out=left)
        for before, line in zip(lines, lines[1:], strict=False):
            np.maximum(before, line, out=line)
        left += steps + gap_open
        np.maximum(new[1:], left[:-1], out=new[1:])
        h[1:] = new
        top = new.max(axis=0)
        better = np.flatnonzero(top > score)
        score[better], at_i[better], at_j[better] = top[better], i + 1, new[:, better].argmax(axis=0) + 1
    return score, at_i, at_j


def _program(tops: list[str], bottoms: list[str], mode: str, scores: tuple[int, int, int, int] | Matrix, codes: tuple[np.ndarray, np.ndarray] | None = None) -> list[dict] | dict[str, np.ndarray | list[str]]:
    """The full program over the pairs: rows of a result, or its columns where the texts are given as codes."""
    rows = _Rows(tops, bottoms, mode, scores)
    if rows.n == 1 and (rows.w1 + 1) * (rows.w2 + 1) > CELLS:
        return [_align_long(rows, tops[0], bottoms[0], mode, scores)]
    h, up = rows.first()
    moves = np.empty((rows.w1 + 1, rows.n, rows.w2 + 1), np.uint8)
    moves[0] = rows.edge_moves()
    best = _Best(rows, h)
    for i in range(1, rows.w1 + 1):
        h, up = rows.row(i, h, up, moves[i])
        best.take(i, h)
    if codes is not None:
        path, size, i, j = _walk_all(moves, best.i, best.j)
        return _measured(*codes, rows.len1, rows.len2, path, size, best.score, i, best.i, j, best.j)
    out = []
    for k in range(rows.n):
        path, i, j, _ = _walk(moves[:, k], 0, int(best.i[k]), int(best.j[k]), 0)
        out.append(_measures(tops[k], bottoms[k], path[::-1], int(best.score[k]), i, int(best.i[k]), j, int(best.j[k])))
    return out


def _walk_all(moves: np.ndarray, ends_i: np.ndarray, ends_j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(moves in order, their number, row and column of the begin) of all pairs at once: one step back of all paths at a time."""
    i, j, n = ends_i.copy(), ends_j.copy(), len(ends_i)
    state, size, steps = np.zeros(n, np.int64), np.zeros(n, np.int64), []
    on = np.flatnonzero((i > 0) | (j > 0))
    while len(on):
        cell = moves[i[on], on, j[on]].astype(np.int64)
        move = np.where(state[on] > 0, state[on], cell & 3)
        if not move.all():
            on, cell, move = on[move > 0], cell[move > 0], move[move > 0]
            if not len(on):
                break
        row = np.zeros(n, np.uint8)
        row[on] = move
        steps.append(row)
        size[on] += 1
        i[on] -= move != 3
        j[on] -= move != 2
        state[on] = np.where((move == 2) & (cell & 4 > 0), 2, np.where((move == 3) & (cell & 8 > 0), 3, 0))
        on = on[(i[on] > 0) | (j[on] > 0)]
    if not steps:
        return np.zeros((n, 0), np.uint8), size, i, j
    back = size[:, None] - 1 - np.arange(len(steps))
    path = np.take_along_axis(np.stack(steps, axis=1), np.maximum(back, 0), 1)
    path[back < 0] = 0
    return path, size, i, j


def _measured(x: np.ndarray, y: np.ndarray, len1: np.ndarray, len2: np.ndarray, moves: np.ndarray, size: np.ndarray, score: np.ndarray, b1: np.ndarray, e1: np.ndarray, b2: np.ndarray, e2: np.ndarray) -> dict[str, np.ndarray | list[str]]:
    """``_measures`` of all pairs at once; moves are filled up with 0."""
    n, width = moves.shape
    inside = moves > 0

    def gapped(codes: np.ndarray, begin: np.ndarray, gap: int) -> np.ndarray:
        held = inside & (moves != gap)
        if not codes.shape[1]:
            return np.where(inside, 45, 0).astype(np.uint8)
        at = np.clip(begin[:, None] + np.cumsum(held, axis=1) - 1, 0, codes.shape[1] - 1)
        return np.where(held, np.take_along_axis(codes, at, 1), np.where(inside, 45, 0)).astype(np.uint8)

    a, b = gapped(x, b1, 3), gapped(y, b2, 2)
    same = ((_upper(a) == _upper(b)) & inside & (a != 45)).sum(axis=1)

    def gaps(row: np.ndarray) -> tuple[np.ndarray, ...]:
        gap, letter = row == 45, inside & (row != 45)
        first = gap.copy()
        first[:, 1:] &= ~gap[:, :-1]
        some = letter.any(axis=1)
        lead = np.where(some, letter.argmax(axis=1), size) if width else size
        trail = np.where(some, size - 1 - (width - 1 - letter[:, ::-1].argmax(axis=1)), size) if width else size
        return first.sum(axis=1), gap.sum(axis=1), lead, trail

    (g1, l1, h1, t1), (g2, l2, h2, t2) = gaps(a), gaps(b)
    part = lambda over, of: np.divide(over, of, out=np.zeros(n), where=of > 0)

    def texts(row: np.ndarray) -> list[str]:
        whole = row.tobytes().decode("ascii")
        return [whole[k * width : k * width + s] for k, s in enumerate(size.tolist())]

    return {
        "score": score, "identical": same, "alnlen": size, "identity": part(same, size), "nogap_identity": part(same, size - l1 - l2), "noterm_identity": part(same, size - np.maximum(h1, h2) - np.maximum(t1, t2)),
        "cov_ref": part(e1 - b1, len1), "cov_read": part(e2 - b2, len2), "ref_begin": b1, "ref_end": e1 - 1, "read_begin": b2, "read_end": e2 - 1,
        "gaps_ref": g1, "gaps_read": g2, "gaplen_ref": l1, "gaplen_read": l2, "top": texts(a), "bottom": texts(b),
    }


def _align_long(rows: _Rows, top: str, bottom: str, mode: str, scores: tuple[int, int, int, int] | Matrix) -> dict:
    """One long pair: a first pass keeps every ``step``-th row; from the best end back, the moves of one interval at a time are made again.

    Memory is about width * sqrt(height) * 6 bytes, time twice that of the scores; the alignment is the same as with all moves at hand.
    """
    step = max(1, int((8 * rows.w1) ** 0.5))
    h, up = rows.first()
    best, kept = _Best(rows, h), {0: (h, up)}
    for i in range(1, rows.w1 + 1):
        h, up = rows.row(i, h, up, None)
        best.take(i, h)
        if i % step == 0:
            kept[i] = (h, up)
    i, j, state, path = int(best.i[0]), int(best.j[0]), 0, []
    while True:
        base = max(0, (i - 1) // step * step)
        part = _Rows([top[:i]], [bottom[:j]], mode, scores)
        h, up = (a[:, : j + 1] for a in kept[base])
        moves = np.empty((i - base + 1, 1, j + 1), np.uint8)
        moves[0] = part.edge_moves()
        for k in range(base + 1, i + 1):
            h, up = part.row(k, h, up, moves[k - base])
        more, i, j, state = _walk(moves[:, 0], base, i, j, state)
        path += more
        if base == 0 or state is None:
            break
    return _measures(top, bottom, path[::-1], int(best.score[0]), i, int(best.i[0]), j, int(best.j[0]))


def _walk(moves: np.ndarray, base: int, i: int, j: int, state: int) -> tuple[list[int], int, int, int | None]:
    """(moves, last first; row, column, open gap) from (i, j) back to row base, or to where the alignment begins (open gap None)."""
    path = []
    while i > base or (base == 0 and j > 0):
        cell = int(moves[i - base, j])
        move = state or cell & 3
        if move == 0:
            return path, i, j, None
        path.append(move)
        if move == 1:
            i, j, state = i - 1, j - 1, 0
        elif move == 2:
            i, state = i - 1, 2 if cell & 4 else 0
        else:
            j, state = j - 1, 3 if cell & 8 else 0
    return path, i, j, state


def _measures(top: str, bottom: str, path: list[int], score: int, b1: int, e1: int, b2: int, e2: int) -> dict:
    moves = np.array(path, np.uint8)

    def gapped(text: str, begin: int, gap: int) -> np.ndarray:
        out = np.full(len(moves), ord("-"), np.uint32)
        held = moves != gap
        out[held] = np.frombuffer(text[begin : begin + int(held.sum())].encode("utf-32-le"), np.uint32)
        return out

    a, b = gapped(top, b1, 3), gapped(bottom, b2, 2)
    upper = lambda x: np.where((x >= 97) & (x <= 122), x - 32, x)
    same = int(((upper(a) == upper(b)) & (a != 45)).sum())

    def gaps(row: np.ndarray) -> tuple[int, int, int, int]:
        """Runs of gaps, gap columns, those at the begin and at the end."""
        gap = row == 45
        letters = np.flatnonzero(~gap)
        lead, trail = (int(letters[0]), len(row) - 1 - int(letters[-1])) if len(letters) else (len(row), len(row))
        return int((gap & ~np.append(False, gap[:-1])).sum()) if len(row) else 0, int(gap.sum()), lead, trail

    (g1, l1, h1, t1), (g2, l2, h2, t2) = gaps(a), gaps(b)
    share = lambda n: same / n if n > 0 else 0.0
    text = lambda row: row.astype("<u4").tobytes().decode("utf-32-le")
    return {
        "score": score, "identical": same, "alnlen": len(a), "identity": share(len(a)), "nogap_identity": share(len(a) - l1 - l2), "noterm_identity": share(len(a) - max(h1, h2) - max(t1, t2)),
        "cov_ref": (e1 - b1) / len(top) if top else 0.0, "cov_read": (e2 - b2) / len(bottom) if bottom else 0.0, "ref_begin": b1, "ref_end": e1 - 1, "read_begin": b2, "read_end": e2 - 1,
        "gaps_ref": g1, "gaps_read": g2, "gaplen_ref": l1, "gaplen_read": l2, "top": text(a), "bottom": text(b),
    }


def align_pairs(pairs: DataFrame, mode: str = "local", scores: tuple[int, int, int, int] | Matrix = SCORES["reads"], ref: str = "ref_seq", read: str = "read_seq", better_strand: bool = False, least: int = 0) -> DataFrame:
    """pairs with the columns of RESULT. Null sequences count as empty. Pairs that come straight from a file should be ``spread`` first.

    With ``better_strand`` (local mode) each read is aligned on the strand that scores more, forward of equals, and its columns come with ``strand``. Pairs whose local score is under ``least`` are left out, by their scores alone.
    """
    more = [T.StructField("strand", T.StringType())] if better_strand else []
    schema = T.StructType([*pairs.schema.fields, *more, *T._parse_datatype_string(RESULT).fields])
    names = [f.name for f in T._parse_datatype_string(RESULT).fields]

    kinds = {"int": pa.int32(), "double": pa.float64(), "string": pa.string()}
    types = [kinds[f.split()[1]] for f in RESULT.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            texts = [[t or "" for t in batch.column(c).to_pylist()] for c in (ref, read)]
            if least > 0 and mode == "local" and len(batch):
                enough = _enough(*texts, scores, least)
                batch, texts = batch.take(pa.array(enough)), [[side[k] for k in enough] for side in texts]
            # pairs of like size together
            order = np.lexsort([[len(t) for t in side] for side in texts[::-1]]) if len(batch) else np.empty(0, np.int64)
            tops, bottoms = ([side[k] for k in order] for side in texts)
            while at < len(batch):
                end = at + 1
                w1, w2 = len(tops[at]), len(bottoms[at])
                while end < len(batch):
                    a, b = max(w1, len(tops[end])), max(w2, len(bottoms[end]))
                    if (a + 1) * (b + 1) * (end + 1 - at) > CELLS:
                        break
                    w1, w2, end = a, b, end + 1
                if better_strand:
                    turned, made = align_strands(tops[at:end], bottoms[at:end], scores)
                    strand = [pa.array(np.where(turned, "-", "+"), pa.string())]
                else:
                    made, strand = align_table(tops[at:end], bottoms[at:end], mode, scores), []
                held = batch.take(pa.array(order[at:end]))
                yield pa.RecordBatch.from_arrays([*held.columns, *strand, *[pa.array(made[c], t, from_pandas=False) for c, t in zip(names, types, strict=True)]], names=schema.names)
                at = end

    return pairs.mapInArrow(run, schema)


def _turned(text: str) -> str:
    return text.translate(_COMPLEMENT)[::-1]


_COMPLEMENT = str.maketrans({**dict(zip(S.NUCLEOTIDES, S.COMPLEMENTS, strict=True)), "U": "A", "u": "a"})


def align_strands(tops: list[str], bottoms: list[str], scores: tuple[int, int, int, int]) -> tuple[np.ndarray, dict[str, np.ndarray | list[str]]]:
    """(turned, columns of RESULT) of the better strand of each bottom, the given one of equals; only that one is aligned in full."""
    back = [_turned(b) for b in bottoms]
    turned = best_scores(tops, back, scores) > best_scores(tops, bottoms, scores)
    return turned, align_table(tops, [b if t else a for a, b, t in zip(bottoms, back, turned, strict=True)], "local", scores)


def _enough(tops: list[str], bottoms: list[str], scores: tuple[int, int, int, int] | Matrix, least: int) -> np.ndarray:
    """Places of the pairs whose local score is ``least`` or more; of all where scores alone cost as much as alignments."""
    # pairs of like size together, so that few cells are filled up
    order = np.lexsort([[len(t) for t in side] for side in (bottoms, tops)])
    kept = []
    for k in range(0, len(order), PAIRS):
        part = order[k : k + PAIRS]
        a, b = [tops[i] for i in part], [bottoms[i] for i in part]
        simple = all(t.isascii() for t in a) and all(t.isascii() for t in b) and _small(_bytes(a), _bytes(b), scores)
        kept.append(part[best_scores(a, b, scores) >= least] if simple else part)
    return np.sort(np.concatenate(kept))


def _passing_score(identity: float, length: int, scores: tuple[int, int, int, int]) -> int:
    """No alignment with these cuts scores less: each column that differs costs a mismatch or the opening of a gap at most. 0 where that says nothing."""
    match, worst = scores[0], min(scores[1:])
    if not 0 < identity <= 1 or length < 1 or match * identity + worst * (1 - identity) <= 0:
        return 0
    # of the lengths where one more column may differ the first scores least, and later ones score more
    return max(0, min(match * (n - _errors(identity, n)) + worst * _errors(identity, n) for n in range(length, length + int(2 / max(1 - identity, 0.01)) + 2)))


def every_kmer(seq: str | Column, k: int) -> Column:
    s = S.col(seq)
    return F.when(F.length(s) >= k, F.transform(F.sequence(F.lit(1), F.length(s) - k + 1), lambda i: F.substring(s, i, F.lit(k)))).otherwise(F.array().cast("array<string>"))


def kmers(seq: str | Column, k: int) -> Column:
    return F.array_distinct(every_kmer(seq, k))


def seed_pairs(reads: DataFrame, refs: DataFrame, k: int = 12, shared: int = 2, both_strands: bool = True) -> DataFrame:
    """(read_id, ref_id, strand): pairs where at least ``shared`` places of the read begin a k-mer that the reference has, by equi-join."""
    forward = reads.select("read_id", F.lit("+").alias("strand"), F.upper("seq").alias("seq"))
    both = forward.unionByName(reads.select("read_id", F.lit("-").alias("strand"), F.upper(S.revcomp("seq")).alias("seq"))) if both_strands else forward
    left = both.select("read_id", "strand", F.explode(kmers("seq", k) if shared < 2 else every_kmer("seq", k)).alias("kmer"))
    right = refs.select("ref_id", F.explode(kmers(F.upper("seq"), k)).alias("kmer"))
    return left.join(right.hint("merge"), "kmer").groupBy("read_id", "ref_id", "strand").agg(F.count("*").alias("n")).filter(F.col("n") >= shared).drop("n")


def _errors(identity: float, n: int) -> int:
    """Most columns that may differ among n."""
    return next(e for e in range(n, -1, -1) if (n - e) / n >= identity)


def shared_kmers(identity: float, length: int, k: int) -> int:
    """Places of a read that begin a common k-mer in any alignment with these cuts: each differing column spoils k of them.

    Of the lengths where one more column may differ the first has fewest; 1 at least, as ``lossless_seed`` grants.
    """
    return max(1, min(n - k + 1 - k * _errors(identity, n) for n in range(length, length + int(2 / max(1 - identity, 0.01)) + 2)))


def lossless_seed(identity: float, length: int) -> int:
    """Letters that any alignment with these cuts has in one exact run, by the pigeonhole rule; 0 if under 4.

    Of n columns at most e differ, which leaves e + 1 runs. More columns with the same e make longer runs,
    and of the lengths where e grows the first is the worst.
    """
    if not 0 < identity <= 1 or length < 4:
        return 0
    least = length
    for n in range(length, length + int(2 / max(1 - identity, 0.01)) + 2):
        e = _errors(identity, n)
        least = min(least, -((e - n) // (e + 1)))
    return least if least >= 4 else 0


def _unseen_score(n: Column, k: int, scores: tuple[int, int, int, int]) -> Column:
    """No alignment of a read of n letters without an exact run of k letters scores more: each end of a run costs a break."""
    match, mismatch, gap_open, _ = scores
    cost = max(mismatch - match, gap_open)
    breaks = F.floor((n + k) / k) - 1
    return F.greatest(match * n + cost * breaks, F.when(breaks > 0, match * (k * breaks - 1) + cost * (breaks - 1)))


#: Letters of a block of ``block_pairs``; a read's first four blocks count, or three.
BLOCK = 8


#: Letters of references, or of reads' beginnings, that are hashed at once; longer texts are cut into pieces that overlap.
LETTERS = 1 << 20


def _window_keys(texts: list[str], size: int, apart: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, turned, palindrome) of the window that begins at each letter of all texts one after another: ``size`` letters, or twice as many with ``apart`` letters between.

    A window and its reverse complement have the same key, and turned tells them apart. Case does not count, U counts as T. Windows beyond a text's end are made too.
    """
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    codes = np.where((codes >= 97) & (codes <= 122), codes - 32, codes)
    codes = np.where(codes == 85, 84, codes).astype(np.uint64)
    other = np.where(codes < 128, _OTHER[np.minimum(codes, 127)], codes)

    def rolled(of: np.ndarray, order: range) -> np.ndarray:
        out = np.zeros(len(of), np.uint64)
        for k in order:
            out *= np.uint64(0x100000001B3)
            out[: len(of) - k] += of[k:]
        return out

    ahead, back = rolled(codes, range(size)), rolled(other, range(size - 1, -1, -1))
    if apart:
        far = size + apart
        shift = lambda x: np.concatenate([x[far:], np.zeros(min(far, len(x)), np.uint64)])
        odd = np.uint64(0x9E3779B97F4A7C15)
        ahead, back = ahead * odd + shift(ahead), shift(back) * odd + back
    key = np.minimum(ahead, back)
    key = (key ^ (key >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (key ^ (key >> np.uint64(29))).view(np.int64), ahead > back, ahead == back


_OTHER = np.arange(128, dtype=np.uint64)
_OTHER[[ord(c) for c in S.NUCLEOTIDES]] = [ord(c) for c in S.COMPLEMENTS]


def _block_keys(df: DataFrame, name: str, every: bool) -> DataFrame:
    """(name, key, turned): the keys of all windows of two blocks, or only of a text's first two that don't overlap, of each two of its three blocks where it has no four."""
    schema = T.StructType([df.schema[name], T.StructField("key", T.LongType()), T.StructField("turned", T.BooleanType())])

    def keys(owner: np.ndarray, texts: list[str]) -> tuple[np.ndarray, ...]:
        sizes = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(sizes)
        row, left = np.repeat(np.arange(len(texts)), sizes), np.repeat(ends, sizes) - np.arange(ends[-1])
        made = []
        for width, (key, turned, same) in ((2 * BLOCK, _window_keys(texts, 2 * BLOCK)), (3 * BLOCK, _window_keys(texts, BLOCK, BLOCK))):
            if every:
                at = np.flatnonzero(left >= width)
            else:
                begins, long = ends - sizes, sizes >= 4 * BLOCK
                at = np.concatenate([begins, begins + np.where(long, 2, 1) * BLOCK]) if width == 2 * BLOCK else begins[~long]
            made.append((owner[row[at]], key[at], turned[at]))
            if every:  # a palindrome is met in both directions
                twice = at[same[at]]
                made.append((owner[row[twice]], key[twice], ~turned[twice]))
        return tuple(np.concatenate(c) for c in zip(*made, strict=True))

    def pieces(column: pa.Array) -> Iterator[tuple[int, str]]:
        for k, text in enumerate(column.to_pylist()):
            if text is None or len(text) < (2 if every else 3) * BLOCK:
                continue
            whole = text.upper()
            text = whole if len(whole) == len(text) else text
            if every:
                yield from ((k, text[at : at + LETTERS + 3 * BLOCK]) for at in range(0, len(text) - 2 * BLOCK + 1, LETTERS))
            else:
                yield k, text[: 4 * BLOCK]

    def made(batch: pa.RecordBatch, owner: list[int], texts: list[str]) -> pa.RecordBatch:
        who, key, turned = keys(np.array(owner), texts)
        if every:
            order = np.lexsort((turned, key, who))
            who, key, turned = who[order], key[order], turned[order]
            new = np.ones(len(who), bool)
            new[1:] = (who[1:] != who[:-1]) | (key[1:] != key[:-1]) | (turned[1:] != turned[:-1])
            who, key, turned = who[new], key[new], turned[new]
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(who)), pa.array(key), pa.array(turned)], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, texts, held = [], [], 0
            for k, piece in pieces(batch.column(1)):
                if owner and held + len(piece) > LETTERS:
                    yield made(batch, owner, texts)
                    owner, texts, held = [], [], 0
                owner.append(k)
                texts.append(piece)
                held += len(piece)
            if owner:
                yield made(batch, owner, texts)

    return df.select(name, "seq").mapInArrow(run, schema)


def block_pairs(reads: DataFrame, refs: DataFrame, both_strands: bool = True, by: str = "read_id") -> DataFrame:
    """(read_id, ref_id, strand): pairs where two of the read's first blocks of 8 letters stand in the reference, on either strand, as far apart as in the read.

    The two are the first and second or the third and fourth; of a read with three blocks any two. Two blocks are 16 letters, so unlike with short k-mers chance meetings
    stay few where references are many. A window and its reverse complement have one key, so a read has two or three keys for both strands.
    Equal hashes of other letters only add a pair. Rows are spread by the column ``by``.
    """
    left, right = _block_keys(reads, "read_id", False), _block_keys(spread(refs.select("ref_id", "seq")), "ref_id", True).withColumnRenamed("turned", "ref_turned")
    strand = F.when(F.col("turned") == F.col("ref_turned"), "+").otherwise("-")
    rows = left.join(right.hint("merge"), "key").select("read_id", "ref_id", strand.alias("strand"))
    parts = int(reads.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows if both_strands else rows.filter("strand = '+'")).repartition(parts, by).distinct()


def _unseen_by_blocks(n: Column, scores: tuple[int, int, int, int]) -> Column:
    """No alignment of a read of n letters that ``block_pairs`` doesn't find scores more: it has a gap, or each of two blocks lacks a letter."""
    match, _, gap_open, _ = scores
    return F.when(n >= 3 * BLOCK, match * n - min(2 * match, -gap_open))


def align_join(reads: DataFrame, refs: DataFrame, mode: str = "local", scores: tuple[int, int, int, int] = SCORES["reads"], both_strands: bool = True, seed: bool = True, k: int = 12, identity: float = 0.0, length: int = 0, top: bool = False) -> DataFrame:
    """Alignments of reads (read_id, seq) with references (ref_id, seq) that pass the cuts; with ``top`` the best reference of each read.

    No alignment that passes the cuts is lost. Pairs need a common run of ``lossless_seed`` letters. With ``top``
    pairs of blocks come first, then k-mers, and only reads whose best score could be beaten without such a block or k-mer go on to shorter
    ones. Where the cuts allow no seed, and with seed=False, every pair is aligned.
    """
    least = lossless_seed(identity, length) if seed else 0
    passing = _passing_score(identity, length, scores) if mode == "local" else 0
    if not top:
        return _aligned(reads, refs, least, mode, scores, both_strands, passing).filter((F.col("identity") >= identity) & (F.col("alnlen") >= length))
    steps = [*sorted({n for n in (k, (k + least) // 2) if n > max(least, 4)}, reverse=True), least] if seed else [0]
    if seed and scores[0] > 0 >= scores[1]:
        steps.insert(0, "blocks")
    letters = refs.agg(F.sum(F.length("seq"))).first()[0] or 0
    if passing and letters <= FEW_LETTERS:
        steps = [0]  # the scores of all pairs cost less than short seeds
    done, left, spark = [], reads.select("read_id", "seq"), reads.sparkSession
    for n in steps:
        best = _best(left, refs, n, mode, scores, both_strands, identity, length, passing, letters <= SENT_LETTERS)
        if n == steps[-1]:
            done.append(best.filter("ref_id is not null").drop("read_length", "texts"))
            break
        size = F.col("read_length")
        sure = F.col("score") > (_unseen_by_blocks(size, scores) if n == "blocks" else _unseen_score(size, n, scores))
        path = shared_folder(spark, "aligned")
        best = best.withColumn("texts", F.when(~F.coalesce(sure, F.lit(False)), F.col("texts"))).drop("read_length")
        best.write.option("compression", "zstd").parquet(path)
        stored = spark.read.schema(best.schema).parquet(path)
        done.append(stored.filter("texts is null").drop("texts"))
        left = stored.filter("texts is not null").select("read_id", F.explode("texts").alias("seq"))
        if not left.head(1):
            break
    return functools.reduce(DataFrame.unionByName, done)


#: References of so many letters in all are sent to all tasks; with so few, all pairs are aligned.
SENT_LETTERS, FEW_LETTERS = 4 << 20, 256


def _best(reads: DataFrame, refs: DataFrame, seed: int | str, mode: str, scores: tuple[int, int, int, int], both_strands: bool, identity: float, length: int, passing: int, few: bool) -> DataFrame:
    """(ref_id, strand, read_id, RESULT, read_length, texts): one row a read id with its best alignment that passes the cuts, nulls where it has none, and the texts under that id.

    Pairs come by blocks, by k-mers (seed is k), or are all (0). They take the reference's text where they are parted by references, else with ``few`` letters
    from all of them, and meet the read where they are parted by reads; the kernel sees all pairs of a read one after another and keeps the best, of equals the one on
    the forward strand, then of least reference id.
    """
    n = int(reads.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # the kernel is the work, which small shuffles would put in one task
    texts = refs.select("ref_id", F.col("seq").alias("ref_seq"))
    dealt = reads.repartition(n, "read_id")
    if seed == 0:
        turns = texts.select("ref_id", F.explode(F.array(*[F.lit(s) for s in ("+-" if both_strands else "+")])).alias("strand"), "ref_seq")
        rows = dealt.sortWithinPartitions("read_id").crossJoin(F.broadcast(turns)) if few else dealt.crossJoin(turns).repartition(n, "read_id").sortWithinPartitions("read_id")
    else:
        by = "read_id" if few else "ref_id"
        pairs = block_pairs(reads, refs, both_strands, by) if seed == "blocks" else seed_pairs(reads, refs, seed, 1, both_strands).repartition(n, by)
        found = pairs.join(F.broadcast(texts), "ref_id") if few else pairs.join(texts.repartition(n, "ref_id").hint("merge"), "ref_id").repartition(n, "read_id")
        rows = dealt.join(found.hint("merge"), "read_id", "left").sortWithinPartitions("read_id")
    rows = rows.select("ref_id", "strand", "read_id", "seq", "ref_seq")
    result = T._parse_datatype_string(RESULT).fields
    schema = T.StructType([*[T.StructField(c, rows.schema[c].dataType) for c in ("ref_id", "strand", "read_id")], *result, T.StructField("read_length", T.IntegerType()), T.StructField("texts", T.ArrayType(T.StringType()))])
    kinds = {"int": pa.int32(), "double": pa.float64(), "string": pa.string()}
    types = [kinds[f.split()[1]] for f in RESULT.split(",")]
    screened = passing if seed != "blocks" else 0  # most pairs of blocks pass

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = None
        for batch in batches:
            if not len(batch):
                continue
            made = best_of(batch)
            if open_ is not None and open_["read_id"][0].is_valid and open_["read_id"][0] == made["read_id"][0]:
                made = pa.concat_tables([joined(open_, made.slice(0, 1)), made.slice(1)])
            elif open_ is not None:
                yield from open_.to_batches()
            if len(made) > 1:
                yield from made.slice(0, len(made) - 1).combine_chunks().to_batches()
            open_ = made.slice(len(made) - 1)
        if open_ is not None:
            yield from open_.to_batches()

    def joined(one: pa.Table, two: pa.Table) -> pa.Table:
        """One row of two rows of the same read, whose pairs came in two batches."""
        a, b = one.to_pylist()[0], two.to_pylist()[0]
        rank = lambda r: (r["ref_id"] is not None, r["score"], r["identity"], r["strand"] == "+")
        first = b["ref_id"] is None or (a["ref_id"] is not None and (rank(a) > rank(b) or (rank(a) == rank(b) and a["ref_id"] <= b["ref_id"])))
        kept = one if first else two
        texts = pa.array([list(dict.fromkeys(a["texts"] + b["texts"]))], pa.list_(pa.string()))
        return kept.set_column(kept.schema.get_field_index("texts"), kept.schema.field("texts"), texts)

    def best_of(batch: pa.RecordBatch) -> pa.Table:
        """One row a read of the batch."""
        ids, size = batch.column("read_id"), len(batch)
        new = np.ones(size, bool)
        if size > 1:
            new[1:] = pc.fill_null(pc.not_equal(ids[1:], ids[:-1]), True).to_numpy(zero_copy_only=False)
        run_of, first = np.cumsum(new) - 1, np.flatnonzero(new)
        paired = np.flatnonzero(batch.column("ref_id").is_valid().to_numpy(zero_copy_only=False))
        read_texts = batch.column("seq").to_pylist()
        strands = batch.column("strand").to_pylist()
        tops = [t or "" for t in batch.column("ref_seq").take(pa.array(paired)).to_pylist()]
        bottoms = [(_turned(read_texts[k]) if strands[k] == "-" else read_texts[k]) if read_texts[k] else "" for k in paired.tolist()]
        where, columns = _kept(tops, bottoms, mode, scores, screened, passing, identity, length)
        at = paired[where]
        # of a read's alignments the greatest comes last
        plus = np.array([strands[k] == "+" for k in at.tolist()], bool)
        order = np.lexsort((plus, columns["identity"], columns["score"], run_of[at]))
        run_at = run_of[at][order]
        last = np.flatnonzero(np.append(run_at[1:] != run_at[:-1], True)) if len(at) else np.empty(0, np.int64)
        top = order[last]
        many = np.flatnonzero(np.diff(last, prepend=-1) > 1)
        for k in many.tolist():
            equal = [c for c in order[(last[k - 1] + 1 if k else 0) : last[k] + 1].tolist() if all(columns[x][c] == columns[x][top[k]] for x in ("score", "identity")) and plus[c] == plus[top[k]]]
            if len(equal) > 1:
                top[k] = min(equal, key=lambda c: batch.column("ref_id")[int(at[c])].as_py())
        place = np.full(len(first), -1)
        place[run_at[last]] = np.arange(len(last))
        none = place < 0
        take = pa.array(np.where(none, 0, place), mask=none)
        chosen = at[top]
        texts = [[read_texts[k]] for k in first.tolist()]
        if len(first) < size:
            for k in np.flatnonzero(~new).tolist():
                own = texts[run_of[k]]
                if read_texts[k] not in own:
                    own.append(read_texts[k])
        best = [batch.column(c).take(pa.array(chosen)).take(take) for c in ("ref_id", "strand")]
        values = [pa.array(np.asarray(columns[f.name], object if f.name in ("top", "bottom") else None)[top], t, from_pandas=False).take(take) for f, t in zip(result, types, strict=True)]
        lengths = pa.array([len(read_texts[k]) if read_texts[k] is not None else None for k in chosen.tolist()], pa.int32()).take(take)
        return pa.table([*best, ids.take(pa.array(first)), *values, lengths, pa.array(texts, pa.list_(pa.string()))], names=schema.names)

    return rows.mapInArrow(run, schema)


def _kept(tops: list[str], bottoms: list[str], mode: str, scores: tuple[int, int, int, int], screened: int, passing: int, identity: float, length: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """(places, columns of RESULT) of the pairs whose alignments pass the cuts; with ``screened`` scores alone come first."""
    at = _enough(tops, bottoms, scores, screened) if screened > 0 and mode == "local" and tops else np.arange(len(tops))
    at = at[np.lexsort([[len(side[k]) for k in at] for side in (bottoms, tops)])] if len(at) else at
    parts = [(at[:0], {c: np.asarray(v) for c, v in align_table([], [], mode, scores).items()})]
    begin = 0
    while begin < len(at):
        end, w1, w2 = begin + 1, len(tops[at[begin]]), len(bottoms[at[begin]])
        while end < len(at):
            a, b = max(w1, len(tops[at[end]])), max(w2, len(bottoms[at[end]]))
            if (a + 1) * (b + 1) * (end + 1 - begin) > CELLS or end - begin >= PAIRS:
                break
            w1, w2, end = a, b, end + 1
        part = at[begin:end]
        made = align_table([tops[k] for k in part], [bottoms[k] for k in part], mode, scores)
        good = np.flatnonzero((np.asarray(made["identity"]) >= identity) & (np.asarray(made["alnlen"]) >= length))
        parts.append((part[good], {c: np.asarray(v, object if c in ("top", "bottom") else None)[good] for c, v in made.items()}))
        begin = end
    return np.concatenate([p for p, _ in parts]), {c: np.concatenate([v[c] for _, v in parts]) for c in parts[0][1]}


def _aligned(reads: DataFrame, refs: DataFrame, k: int, mode: str, scores: tuple[int, int, int, int], both_strands: bool, passing: int = 0) -> DataFrame:
    """Alignments of the pairs with a common k-mer, of all if k is 0, that score ``passing`` or more."""
    if k:
        pairs = seed_pairs(reads, refs, k, 1, both_strands)
    else:
        strands = F.explode(F.array(*[F.lit(s) for s in ("+-" if both_strands else "+")]))
        pairs = reads.select("read_id").join(refs.select("ref_id")).withColumn("strand", strands)
    r = reads.select("read_id", F.col("seq").alias("__s"))
    pairs = pairs.join(r.hint("merge"), "read_id").join(refs.select("ref_id", F.col("seq").alias("ref_seq")).hint("merge"), "ref_id")
    pairs = pairs.select("read_id", "ref_id", "strand", "ref_seq", F.when(F.col("strand") == "-", S.revcomp("__s")).otherwise(F.col("__s")).alias("read_seq"))
    n = int(reads.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # the kernel is the work, which small shuffles would put in one task
    return align_pairs(pairs.repartition(n, "read_id", "ref_id"), mode, scores, least=passing).drop("ref_seq", "read_seq")


def pairwise_similarity(seqs: DataFrame, scores: tuple[int, int, int, int] = SCORES["global"], block: str | None = None, queries: Column | None = None) -> DataFrame:
    """(a, b, identity) of global alignments of all pairs; with ``block`` only of rows that agree in that column.

    ``queries`` states a set of rows: each of them is aligned with every other row, a being the query.
    """
    if queries is not None:
        a = seqs.filter(queries).select(F.col("seq_id").alias("a"), F.col("seq").alias("ref_seq"))
        n = int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        pairs = seqs.select(F.col("seq_id").alias("b"), F.col("seq").alias("read_seq")).repartition(n, "b").join(a, F.col("a") != F.col("b"))
        return align_pairs(pairs.select("a", "b", "ref_seq", "read_seq"), "global", scores).select("a", "b", "identity")
    a = seqs.select(F.col("seq_id").alias("a"), F.col("seq").alias("ref_seq"), *([F.col(block).alias("__b")] if block else []))
    b = seqs.select(F.col("seq_id").alias("b"), F.col("seq").alias("read_seq"), *([F.col(block).alias("__c")] if block else []))
    on = F.col("a") < F.col("b")
    pairs = a.join(b, on & (F.col("__b") == F.col("__c")) if block else on).select("a", "b", "ref_seq", "read_seq")
    return align_pairs(pairs, "global", scores).select("a", "b", "identity")


def orient(reads: DataFrame, refs: DataFrame, k: int = 12) -> DataFrame:
    """Reads reverse-complemented where more of their k-mers agree with the references on the other strand."""
    # a k-mer of the references votes for a read that has it, its reverse complement against it: a read needs its own k-mers only
    one = refs.select(F.explode(kmers("seq", k)).alias("kmer")).distinct()
    rows = one.select(F.explode(F.array(F.struct("kmer", F.lit(1).alias("d")), F.struct(S.revcomp("kmer").alias("kmer"), F.lit(-1).alias("d")))).alias("v")).select("v.*")
    known = rows.groupBy("kmer").agg(F.sum("d").alias("d")).filter("d <> 0")
    # sizes after explode are not foreseen: without the hints all k-mers of the references would be broadcast
    votes = reads.select("read_id", F.explode(kmers("seq", k)).alias("kmer")).join(known.hint("merge"), "kmer").groupBy("read_id").agg(F.sum("d").alias("vote"))
    turned = F.coalesce("vote", F.lit(0)) < 0
    return reads.join(votes.hint("merge"), "read_id", "left").withColumn("seq", F.when(turned, S.revcomp("seq")).otherwise(F.col("seq"))).withColumn("turned", turned).drop("vote")


def join_mates(first: DataFrame, second: DataFrame, name: str = "read_id") -> DataFrame:
    """(read, dir1, dir2, pair): strands of a read's two alignments, ``?`` where one is missing."""
    a = first.select(name, F.col("strand").alias("d1"))
    b = second.select(name, F.col("strand").alias("d2"))
    j = a.join(b, name, "full_outer")
    return j.select(name, F.coalesce("d1", F.lit("?")).alias("dir1"), F.coalesce("d2", F.lit("?")).alias("dir2")).withColumn("pair", F.concat("dir1", "dir2"))


def text_under(top: str, bottom: str, ref_begin: int, begin: int, end: int) -> str | None:
    """The bottom text under 0-based reference positions begin to end, gaps included; null if not covered."""
    at, out, seen = ref_begin, [], 0
    for x, y in zip(top, bottom, strict=True):
        if x != "-":
            if begin <= at <= end:
                out.append(y)
                seen += 1
            at += 1
        elif begin < at <= end:
            out.append(y)
    return "".join(out) if seen == end - begin + 1 else None


def map_site(sites: DataFrame, proteins: DataFrame, references: DataFrame, scores: tuple[int, int, int, int] | Matrix = SCORES["global"]) -> DataFrame:
    """Sites (protein_id, refs ``a|b``, residue, position) with the reference's residue under the position and whether it is valid, or why not."""
    rows = sites.withColumn("ref_id", F.explode(F.split("refs", r"\|"))).join(proteins.select("protein_id", F.col("seq").alias("ref_seq")), "protein_id").join(references.select("ref_id", F.col("seq").alias("read_seq")), "ref_id")
    aligned = align_pairs(rows, "global", scores)

    @F.pandas_udf("string")
    def under(top: pd.Series, bottom: pd.Series, begin: pd.Series, position: pd.Series) -> pd.Series:
        return pd.Series([text_under(t, b, s, p - 1, p - 1) for t, b, s, p in zip(top, bottom, begin, position, strict=True)])

    own = F.substring(F.col("ref_seq"), F.col("position"), F.lit(1))
    found = aligned.withColumn("found", F.substring(under("top", "bottom", "ref_begin", "position"), 1, 1))
    reason = F.when(own != F.col("residue"), "query residue differs").when(~F.col("found").isin("S", "T", "Y", "D"), "no such residue in reference")
    return found.select("protein_id", "ref_id", "position", "residue", "found", reason.isNull().alias("valid"), reason.alias("reason"))


def locate_flanks(reads: DataFrame, left: str, right: str, identity: float = 0.72, coverage: float = 0.65, scores: tuple[int, int, int, int] = SCORES["sites"]) -> DataFrame:
    """(read_id, left_ok, right_ok, identities, insert_begin, insert_end, insert_len), 1-based."""
    refs = reads.sparkSession.createDataFrame([("left", left), ("right", right)], "ref_id string, seq string")
    a = align_join(reads, refs, "local", scores, both_strands=False, seed=False)
    ok = (F.col("identity") > identity) & (F.col("cov_ref") > coverage)
    pick = lambda side, c: F.max(F.when(F.col("ref_id") == side, c))
    g = a.groupBy("read_id").agg(pick("left", ok).alias("left_ok"), pick("right", ok).alias("right_ok"), pick("left", F.col("identity")).alias("left_identity"), pick("right", F.col("identity")).alias("right_identity"), pick("left", F.col("read_end")).alias("l"), pick("right", F.col("read_begin")).alias("r"))
    begin, end = F.when(F.col("left_ok"), F.col("l") + 2).otherwise(1), F.when(F.col("right_ok"), F.col("r"))
    out = g.join(reads.select("read_id", F.length("seq").alias("n")), "read_id").withColumn("insert_begin", begin).withColumn("insert_end", F.coalesce(end, F.col("n")))
    return out.withColumn("insert_len", F.greatest(F.col("insert_end") - F.col("insert_begin") + 1, F.lit(0))).drop("l", "r", "n")


def fish(reads: DataFrame, bait: str, identity: float = 0.88, scores: tuple[int, int, int, int] = SCORES["bait"]) -> DataFrame:
    """(read_id, direction, kind): a read that holds the bait (perfect), else its best passing direction (defect), else none."""
    perfect = F.when(F.contains("seq", F.lit(bait)), "forward").when(F.contains(S.revcomp("seq"), F.lit(bait)), "backward")
    marked = reads.withColumn("__p", perfect)
    rest = marked.filter(F.col("__p").isNull()).drop("__p")
    refs = reads.sparkSession.createDataFrame([("bait", bait)], "ref_id string, seq string")
    a = align_join(rest, refs, "local", scores, seed=False, top=True).filter((F.col("identity") > identity) & (F.col("cov_ref") > 0.7))
    found = a.select("read_id", F.when(F.col("strand") == "+", "forward").otherwise("backward").alias("__d"))
    j = marked.join(found, "read_id", "left")
    return j.select("read_id", F.coalesce("__p", "__d", F.lit("none")).alias("direction"), F.when(F.col("__p").isNotNull(), "perfect").when(F.col("__d").isNotNull(), "defect").otherwise("none").alias("kind"))


def fish_summary(fished: DataFrame) -> DataFrame:
    return fished.groupBy("direction", "kind").agg(F.count("*").alias("n"))


def cut_sites(reads: DataFrame, head: str, tail: str, scores: tuple[int, int, int, int] = SCORES["sites"]) -> DataFrame:
    """reads with status, and strand and cut (letters before it) of those that are cut where the tail site meets the head site.

    The best of four alignments (two sites, two strands) decides: a cut before a head, after a tail. Bad sites
    (identity under 0.92 or over 2 gaps) discard the read; without a site there is no cut.
    """
    refs = reads.sparkSession.createDataFrame([("head", head), ("tail", tail)], "ref_id string, seq string")
    a = align_join(reads.select("read_id", "seq"), refs, "local", scores, seed=False, top=True, identity=0.84, length=min(17, len(head)))
    bad = (F.col("identity") < 0.92) | (F.col("gaps_ref") > 2) | (F.col("gaps_read") > 2)
    at = F.when(F.col("ref_id") == "head", F.col("read_begin")).otherwise(F.col("read_end") + 1)
    sites = a.select("read_id", F.when(bad, "discard").otherwise("cut").alias("status"), "strand", at.alias("cut"))
    return reads.join(sites, "read_id", "left").withColumn("status", F.coalesce("status", F.lit("no_cut")))


def linearized(sites: DataFrame, least: int = 18) -> DataFrame:
    """(read_id, piece, seq, status) of the reads of ``cut_sites``: left and right pieces, or the whole; pieces under ``least`` go."""
    s = F.when(F.col("strand") == "-", S.revcomp("seq")).otherwise(F.col("seq"))
    two = F.array(F.struct(F.lit("left").alias("piece"), F.substring(s, F.lit(1), F.col("cut")).alias("seq")), F.struct(F.lit("right").alias("piece"), F.substring(s, F.col("cut") + 1, F.length(s)).alias("seq")))
    whole = F.array(F.struct(F.lit("whole").alias("piece"), F.col("seq").alias("seq")))
    pieces = F.when(F.col("status") == "cut", two).when(F.col("status") == "no_cut", whole)
    out = sites.select("read_id", "status", F.explode(pieces).alias("p")).select("read_id", "status", "p.piece", "p.seq")
    return out.filter(F.length("seq") >= least)


def linearize(reads: DataFrame, head: str, tail: str, least: int = 18, scores: tuple[int, int, int, int] = SCORES["sites"]) -> DataFrame:
    """(read_id, piece, seq, status): circular reads cut where the tail site meets the head site (``cut_sites``)."""
    return linearized(cut_sites(reads, head, tail, scores), least)


def site_counts(sites: DataFrame, by: tuple[str, ...] = (), warn: float = 0.2) -> DataFrame:
    """(by, cut, discard, no_cut, ratio, warning) of the reads of ``cut_sites``: a warning where discarded are over ``warn`` of the cut ones; without cut ones the ratio is null and any discarded one warns."""
    n = lambda s: F.count(F.when(F.col("status") == s, 1)).alias(s)
    g = sites.groupBy(*by).agg(n("cut"), n("discard"), n("no_cut"))
    return g.withColumns({"ratio": F.try_divide("discard", "cut"), "warning": F.col("discard") > warn * F.col("cut")})


def sweep_linearized(reads: DataFrame, head: str, tail: str, grid: tuple[tuple[int, int], ...] = ((4, 20), (5, 20), (6, 20), (4, 19), (5, 19), (6, 19)), longer_than: int = 17, least: int = 18) -> DataFrame:
    """(window, cut_quality, cut, discard, no_cut, ratio, warning, n_pieces, mean, std) of each quality trim of the grid with its reads linearized.

    Trims that keep the same letters of a read are aligned once.
    """
    kept = F.array(*[F.struct(F.lit(w).alias("window"), F.lit(c).alias("cut_quality"), S.keep_length_by_quality("qual", w, c).alias("n")) for w, c in grid])
    trims = spread(reads).select(F.col("read_id").alias("name"), "seq", F.explode(kept).alias("t")).select("name", "seq", "t.*").filter(F.col("n") > longer_than)
    each = trims.groupBy("name", "n").agg(F.first("seq").alias("seq"), F.collect_list(F.struct("window", "cut_quality")).alias("trims"))  # at most one entry a trim of the grid
    texts = each.select(F.concat_ws("/", F.col("n").cast("string"), "name").alias("read_id"), F.substring("seq", F.lit(1), F.col("n")).alias("seq"), "trims")
    path = shared_folder(reads.sparkSession, "sites")
    sites = cut_sites(texts, head, tail)
    sites.write.parquet(path)
    sites = reads.sparkSession.read.schema(sites.schema).parquet(path)
    keys = ("window", "cut_quality")
    of = lambda df: df.select(F.explode("trims").alias("t"), *[c for c in df.columns if c != "trims"]).select("t.*", *[c for c in df.columns if c != "trims"])
    counts = site_counts(of(sites), keys)
    length = F.length("seq")
    left, right = F.col("cut"), length - F.col("cut")
    pieces = of(sites.select("trims", F.explode(F.when(F.col("status") == "cut", F.array(left, right)).when(F.col("status") == "no_cut", F.array(length))).alias("m")).filter(F.col("m") >= least))
    return counts.join(pieces.groupBy(*keys).agg(F.count("*").alias("n_pieces"), F.avg("m").alias("mean"), F.stddev_samp("m").alias("std")), list(keys), "left")


def pick_subsequence(library: DataFrame, reference: str, identity: float = 0.8, scores: tuple[int, int, int, int] = SCORES["subsequence"]) -> DataFrame:
    """(seq_id, seq, title): the part of each sequence that aligns with the reference; ambiguous parts are left out."""
    refs = library.sparkSession.createDataFrame([("ref", reference)], "ref_id string, seq string")
    a = align_join(library.select(F.col("seq_id").alias("read_id"), "seq"), refs, "local", scores, both_strands=False, seed=False, identity=identity)
    part = F.replace(F.col("bottom"), F.lit("-"), F.lit(""))
    return a.select(F.col("read_id").alias("seq_id"), part.alias("seq"), F.concat(F.lit("identity="), F.round("identity", 4).cast("string")).alias("title")).filter(S.is_unambiguous("seq"))


def trim_flanks(reads: DataFrame, left: str, right: str, least: int = 18) -> dict[str, DataFrame]:
    """Reads (read_id, seq) sorted by the flanks they have: "inserts" (read_id, class, insert), "classes" and "identities".

    class: both, left, right, none, or short where the insert has fewer than ``least`` letters.
    """
    from seqframe.operators.library import flank_identity_counts

    located = locate_flanks(reads, left, right)
    kind = F.when(~F.col("left_ok") & ~F.col("right_ok"), "none").when(F.col("insert_len") < least, "short").when(F.col("left_ok") & F.col("right_ok"), "both").when(F.col("left_ok"), "left").otherwise("right")
    rows = located.withColumn("class", kind).join(reads.select("read_id", "seq"), "read_id")
    inserts = rows.select("read_id", "class", F.when(F.col("class") != "none", F.substring(F.col("seq"), F.col("insert_begin"), F.col("insert_len"))).alias("insert"))
    return {"inserts": inserts, "classes": inserts.groupBy("class").agg(F.count("*").alias("n")), "identities": flank_identity_counts(located)}
