"""Trees on binned rows: the best split of a node, and the subtree of a bounded node.

A row has one small integer (its bin) per feature, ``MISSING`` for NULL or NaN,
and two weights A and B.  A node is judged by sums of them:

* ``newton``: A gradient, B hessian; score G^2 / (H + lambda), leaf value
  -G / (H + lambda), cut to +-max_delta_step and times the learning rate.
* ``mean``: A weight times label, B weight; score A^2 / B (variance), value A / B.
* ``gini`` / ``entropy`` (labels 0 and 1): A and B the weights of class 1 and 0,
  each times its class weight; value the share of class 1.

A split sends bins up to a bound left and learns the side of missing values: the
right one unless the left one scores higher.  Both children need ``min_leaf``
rows and ``min_child_weight`` of B.  Ties go to the first feature, then to the
lowest bound.  ``features`` limits a node to that many features that can split
it, drawn by a hash of tree and node, so the draw is the same wherever the node
is grown.

Nodes are numbered as in a heap (children 2i and 2i + 1).  Every node keeps its
row count and value, so a tree can be read as if it had been grown less deep or
with a larger ``min_samples_split``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

MISSING = 255
MOST_BINS = 255             # real bins of a feature: 0 to 254
LEAST_GAIN = 1e-6           # of a Newton split
LEAST_SHARE = 1e-9          # of the score, for the other kinds
TIE = 1e-11                 # relative difference of equal scores
UNLIMITED = 60              # deepest heap number that fits 64 bits
SORTED_ROWS = 256           # smaller nodes go on sorted, with twice the bins of a feature on top
SORT_CELLS = 1 << 16        # rows x features that are sorted together
MANY_ROWS, MANY_CELLS = 1 << 15, 1 << 14    # rows of a node whose features are counted together, in so many combinations
SOME_ROWS, SOME_CELLS = 1 << 11, 1 << 10

NODE = np.dtype([("id", "<i8"), ("n", "<i8"), ("a", "<f8"), ("b", "<f8"), ("feature", "<i4"), ("bound", "<i4"), ("left_missing", "?")])


@dataclass(frozen=True)
class Rule:
    kind: str = "newton"
    max_depth: int = 6
    reg_lambda: float = 0.0
    min_child_weight: float = 0.0
    min_leaf: int = 1
    min_split: int = 2                  # rows of a node that may be split
    max_delta_step: float = 0.0
    rate: float = 1.0
    features: int | None = None         # features tried per node; None: all of the tree's

    def weigh(self, a, b, classes):
        """(G, H) of the sums A and B."""
        return (a, b) if self.kind in ("newton", "mean") else (a * classes[0], a * classes[0] + b * classes[1])

    def score(self, g, h):
        if self.kind == "entropy":
            rest = h - g
            whole = np.maximum(h, 1e-300)
            return g * np.log(np.maximum(g, 1e-300) / whole) + rest * np.log(np.maximum(rest, 1e-300) / whole)
        return np.square(g) / np.maximum(h + self.reg_lambda, 1e-300)

    def value(self, a, b, classes=(1.0, 1.0)):
        g, h = self.weigh(np.asarray(a, float), np.asarray(b, float), classes)
        if self.kind != "newton":
            return g / np.maximum(h, 1e-300)
        step = -g / np.maximum(h + self.reg_lambda, 1e-300)
        if self.max_delta_step > 0:
            step = np.clip(step, -self.max_delta_step, self.max_delta_step)
        return self.rate * step

    def least(self, score):
        return LEAST_GAIN if self.kind == "newton" else LEAST_SHARE * np.maximum(np.abs(score), 1.0)


def mixed(x):
    """splitmix64 of an unsigned array."""
    x = (x + np.uint64(0x9E3779B97F4A7C15))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(rows, salt: int):
    """Numbers in [0, 1) from row hashes and a salt."""
    return (mixed(rows ^ mixed(np.array([salt], np.uint64))) >> np.uint64(11)).astype(float) / float(1 << 53)


#: Poisson(1) by inversion: the weights of a bootstrap sample without a shared draw.
BOOTSTRAP = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 16)]))


def bootstrap(rows, salt: int):
    return np.searchsorted(BOOTSTRAP, uniform(rows, salt), side="right").astype(float)


def drawn(valid, ids, columns, many, seed):
    """Of the features that can split (``valid``: features x nodes), ``many`` per node."""
    keys = mixed(mixed(np.asarray(ids, np.int64).view(np.uint64) ^ np.uint64(seed))[None, :] ^ np.asarray(columns, np.uint64)[:, None])
    keys = np.where(valid, keys >> np.uint64(1), np.uint64(2 ** 63))
    rank = np.argsort(np.argsort(keys, axis=0, kind="stable"), axis=0, kind="stable")
    return valid & (rank < many)


class Gains:
    """Best split per node from sums left of every candidate place.

    All arrays are features x places; ``start`` cuts the places into nodes."""

    def __init__(self, rule, classes, start, lengths):
        self.rule, self.classes, self.start, self.lengths = rule, classes, start, lengths

    def spread(self, per_node):
        return np.repeat(per_node, self.lengths, axis=-1)

    def gain(self, a, b, n, whole_a, whole_b, whole_n, ok):
        """Scores at the places that may split, -inf at all others."""
        r = self.rule
        ok = ok & (n >= max(r.min_leaf, 1)) & (whole_n - n >= max(r.min_leaf, 1))
        at, out = np.flatnonzero(ok), np.full(ok.shape, -np.inf)
        node = at % ok.shape[1]
        a, b, whole_a, whole_b = (v[node] if v.ndim == 1 else v.ravel()[at] for v in (a, b, whole_a, whole_b))
        ga, ha = r.weigh(a, b, self.classes)
        gb, hb = r.weigh(whole_a - a, whole_b - b, self.classes)
        found = r.score(ga, ha) + r.score(gb, hb)
        if r.min_child_weight > 0:
            slack = 1e-9 * r.min_child_weight
            found[(ha < r.min_child_weight - slack) | (hb < r.min_child_weight - slack)] = -np.inf
        out.ravel()[at] = found
        return out

    def best(self, a, b, n, whole, missing, ok, ids, columns, seed):
        """(gain, feature row, place, missing values go left) per node.

        ``whole`` (a, b, n) per node; ``missing`` the same per feature and node, or
        None; a gain of -inf where nothing splits."""
        wa, wb, wn = (self.spread(w) for w in whole)
        right = self.gain(a, b, n, wa, wb, wn, ok)
        left = None
        if missing is not None:
            ma, mb, mn = (self.spread(m) for m in missing)
            left = np.where(mn > 0, self.gain(a + ma, b + mb, n + mn, wa, wb, wn, ok), -np.inf)
        both = right if left is None else np.maximum(right, left)
        top = np.maximum.reduceat(both, self.start, axis=1)
        if self.rule.features is not None and self.rule.features < len(columns):
            top = np.where(drawn(np.isfinite(top), ids, columns, self.rule.features, seed), top, -np.inf)
        nodes = np.arange(len(self.start))
        own = self.rule.score(*self.rule.weigh(whole[0], whole[1], self.classes))
        found = top.max(axis=0)
        # scores this close are ties, however their sums were rounded
        enough = found - TIE * np.maximum(np.abs(found), 1.0)
        feature = np.argmax(top >= enough, axis=0)
        gain = np.where(found - own > self.rule.least(own), found - own, -np.inf)
        place = np.full(len(nodes), -1)
        goes_left = np.zeros(len(nodes), bool)
        for k in np.unique(feature):                    # at most one pass per feature
            mine = feature == k
            hit = np.flatnonzero(both[k] >= self.spread(np.where(mine, enough, np.nan)))
            node = np.searchsorted(self.start, hit, side="right") - 1
            first, at = np.unique(node, return_index=True)
            place[first] = hit[at]
        if left is not None:
            some = np.isfinite(gain)
            goes_left[some] = ~(right[feature[some], place[some]] >= enough[some])
        return gain, feature, place, goes_left


def picked_of(v, at):
    """``v[at]`` for places known to lie within: the quickest way numpy has."""
    return v.take(at, mode="clip")


class Layout:
    """Binned rows by feature, and the places of their bins one after another: the
    real bins of all features, then a place for the missing values of each."""

    def __init__(self, bins):
        self.own = np.ascontiguousarray(bins.T)
        p = len(self.own)
        seen = np.stack([np.bincount(column, minlength=256) for column in self.own]) > 0 if p else np.zeros((0, 256), bool)
        self.has_missing = seen[:, MISSING]
        self.widths = np.array([int(np.flatnonzero(s[:MISSING])[-1]) + 1 if s[:MISSING].any() else 0 for s in seen], int)
        self.starts = np.concatenate([[0], np.cumsum(self.widths)])
        self.real = int(self.starts[-1])
        self.places = self.real + int(self.has_missing.sum())
        gone = self.real + np.cumsum(self.has_missing) - 1
        self.cells = [np.concatenate([np.arange(s, s + w), [m]]) if has else np.arange(s, s + w) for s, w, m, has in zip(self.starts, self.widths, gone, self.has_missing)]
        self.gone = np.where(self.has_missing, gone, 0)
        self.all_rows = self.cells[int(np.argmax(self.widths > 0))] if p else np.empty(0, int)       # places that hold every row once
        self.feature = np.repeat(np.arange(p), self.widths)         # of every real place
        self.place_of = np.zeros((p, 256), np.int64)                # of every bin
        for j in range(p):
            self.place_of[j, :self.widths[j]] = self.cells[j][:self.widths[j]]
            self.place_of[j, MISSING] = self.gone[j]
        self.joint = {}
        self.least = SORTED_ROWS + 2 * self.places // max(p, 1)     # rows of a node that is judged by sums

    def together(self, most):
        """[(features, their sizes, one code per row)]: features whose bins, taken
        together, have at most ``most`` combinations, so one count serves them all."""
        if most not in self.joint:
            groups = []
            for j in sorted(range(len(self.own)), key=lambda j: -len(self.cells[j])):
                size = max(len(self.cells[j]), 1)
                for g in groups:
                    if g[0] * size <= most:
                        g[0], g[1] = g[0] * size, g[1] + [j]
                        break
                else:
                    groups.append([size, [j]])
            found = []
            for _, features in groups:
                code = np.zeros(self.own.shape[1], np.int32)
                for j in features:
                    rank = np.zeros(256, np.int32)
                    rank[:self.widths[j]], rank[MISSING] = np.arange(self.widths[j]), self.widths[j]
                    code = code * max(len(self.cells[j]), 1) + rank.take(self.own[j])
                sizes = [max(len(self.cells[j]), 1) for j in features]
                found.append((features, sizes, code.astype(np.uint16) if math.prod(sizes) <= 1 << 16 else code))
            self.joint[most] = found
        return self.joint[most]


class Weights:
    """The weights of rows as few numbers: whole numbers share the bits of one.  Where
    rows need not be counted, ``half`` of the least ``b`` tells whether there are any."""

    def __init__(self, a, b, rows, mine, rule):
        self.unit, self.half = b is None, None
        self.sums = [a] if self.unit else [a, b]
        self.shift, self.packed = [len(mine).bit_length()], []
        for k in range(len(self.sums))[::-1]:           # b first: it is whole more often
            v = mine if k else a if rows is None else picked_of(a, rows)
            if v.min() >= 0 and (v[:64] == np.floor(v[:64])).all() and (v == np.floor(v)).all():
                bits = int(v.sum()).bit_length()
                if sum(self.shift) + bits <= 52:
                    self.packed.append(k)
                    self.shift.append(bits)
        self.alone = [k for k in range(len(self.sums)) if k not in self.packed]
        one, at = None, self.shift[0]
        for k, bits in zip(self.packed, self.shift[1:]):
            one = (1.0 if one is None else one) + self.sums[k] * float(1 << at)
            at += bits
        if not self.unit and not self.packed and rule.min_leaf <= 1 and mine.min() > 1e-9 * mine.sum():
            self.half = 0.5 * float(mine.min())
        self.columns = [self.sums[k] for k in self.alone] if self.half else [one, *[self.sums[k] for k in self.alone]]      # None: the count alone

    def read(self, found):
        """(n, a, b) of sums of ``columns``; with ``half``, n tells only whether there are rows."""
        if self.half:
            return found[1] > self.half, found[0], found[1]
        first, out = found[0], [None] * len(self.sums)
        if self.packed:
            first = first.astype(np.int64)
        n, at = first & ((1 << self.shift[0]) - 1) if self.packed else first, self.shift[0]
        for k, bits in zip(self.packed, self.shift[1:]):
            out[k] = ((first >> at) & ((1 << bits) - 1)).astype(float)
            at += bits
        for k, v in zip(self.alone, found[1:]):
            out[k] = v
        return n, out[0], n.astype(float) if self.unit else out[1]


def level_sums(own, a, b, rows, lay, sizes, weights):
    """Sums (of every column of ``weights``: nodes x places) of nodes that have
    ``sizes`` of the rows numbered ``rows`` (None: all), one node after another."""
    columns = weights.columns
    out = [np.zeros((len(sizes), lay.places), np.int64 if c is None else float) for c in columns]
    ends = np.cumsum(sizes)
    tiers = [[], []]
    rest = []
    for k, n in enumerate(sizes):
        (tiers[0] if n >= MANY_ROWS else tiers[1] if n >= SOME_ROWS else rest).append(k)
    for most, nodes in zip((MANY_CELLS, SOME_CELLS), tiers):
        for a0 in range(0, len(nodes), 16):
            some = nodes[a0:a0 + 16]
            groups = lay.together(most)
            held = [[np.empty((len(some), math.prod(g[1])), np.int64 if c is None else float) for c in columns] for g in groups]
            for i, k in enumerate(some):
                mine = slice(ends[k] - sizes[k], ends[k])
                picked = None if rows is None else rows[mine]
                own_weights = [c if c is None or picked is None else picked_of(c, picked) for c in columns]
                for g, into in zip(groups, held):
                    code = g[2] if picked is None else picked_of(g[2], picked)
                    code = code.astype(np.int64)
                    for w, v in zip(own_weights, into):
                        v[i] = np.bincount(code, w, v.shape[1])
            at = np.array(some)
            for (features, shape, _), into in zip(groups, held):
                for d, j in enumerate(features):
                    if len(lay.cells[j]):
                        others = tuple(x + 1 for x in range(len(shape)) if x != d)
                        for v, whole in zip(into, out):
                            whole[at[:, None], lay.cells[j]] = v.reshape(len(some), *shape).sum(axis=others) if others else v
    if rest:
        picked = (np.concatenate([rows[ends[k] - sizes[k]:ends[k]] for k in rest]) if len(rest) < len(sizes) else rows) if rows is not None else None
        slot = np.repeat(np.arange(len(rest)) * lay.places, [sizes[k] for k in rest])
        own_weights = [c if c is None or picked is None else picked_of(c, picked) for c in columns]
        found = [np.zeros(len(rest) * lay.places, v.dtype) for v in out]
        for j, column in enumerate(own):
            code = picked_of(lay.place_of[j], column if picked is None else picked_of(column, picked)) + slot
            for w, v in zip(own_weights, found):
                v += np.bincount(code, w, len(v))
        for v, whole in zip(found, out):
            whole[rest] = v.reshape(len(rest), lay.places)
    return out


def best_places(rule: Rule, classes, lay: Layout, sums, whole, ids, columns, seed, half=None):
    """As ``Gains.best`` from sums (n, a, b: nodes x places); ``whole`` (a, b, n) per node."""
    n, a, b = sums
    many, real = len(ids), lay.real
    ln, la, lb = (np.empty((many, real), v.dtype) for v in (n, a, b))
    for s, w in zip(lay.starts, lay.widths):
        for v, into in ((n, ln), (a, la), (b, lb))[1 if half else 0:]:
            np.cumsum(v[:, s:s + w], axis=1, out=into[:, s:s + w])
    allowed = n[:, :real] > 0
    if len(columns) < len(lay.widths):
        mine = np.zeros(len(lay.widths), bool)
        mine[columns] = True
        allowed &= mine[lay.feature]
    wa, wb, wn = (w[:, None] for w in whole)
    least = max(rule.min_leaf, 1)

    def gain(ln, la, lb, ok):
        ok = ok & (wb - lb > half) if half else ok & (ln >= least) & (wn - ln >= least)
        if rule.kind == "entropy":                      # dear: only where it may split
            at, found = np.flatnonzero(ok), np.full(ok.shape, -np.inf)
            node = at // real
            xa, xb = la.ravel()[at], lb.ravel()[at]
            found.ravel()[at] = rule.score(*rule.weigh(xa, xb, classes)) + rule.score(*rule.weigh(whole[0][node] - xa, whole[1][node] - xb, classes))
            return found
        ga, ha = rule.weigh(la, lb, classes)
        gb, hb = rule.weigh(wa - la, wb - lb, classes)
        found = rule.score(ga, ha) + rule.score(gb, hb)
        if rule.min_child_weight > 0:
            slack = 1e-9 * rule.min_child_weight
            ok &= (ha >= rule.min_child_weight - slack) & (hb >= rule.min_child_weight - slack)
        found[~ok] = -np.inf
        return found

    both = right = gain(ln, la, lb, allowed)
    sides = None
    if lay.has_missing.any():
        at = np.where(lay.has_missing[lay.feature], lay.gone[lay.feature], 0)
        mn = np.where(lay.has_missing[lay.feature], n[:, at], 0)
        if mn.any():
            left = gain(None if half else ln + mn, la + a[:, at], lb + b[:, at], allowed & (mn > 0))
            both, sides = np.maximum(right, left), right
    used = np.flatnonzero(lay.widths)
    top = np.maximum.reduceat(both, lay.starts[:-1][used], axis=1).T                # features x nodes
    if rule.features is not None and rule.features < len(columns):
        top = np.where(drawn(np.isfinite(top), ids, used, rule.features, seed), top, -np.inf)
    own = rule.score(*rule.weigh(whole[0], whole[1], classes))
    found = top.max(axis=0)
    enough = found - TIE * np.maximum(np.abs(found), 1.0)
    feature = used[np.argmax(top >= enough, axis=0)]
    value = np.where(found - own > rule.least(own), found - own, -np.inf)
    place = np.argmax((both >= enough[:, None]) & (lay.feature[None, :] == feature[:, None]), axis=1)
    goes_left = ~(sides[np.arange(many), place] >= enough) if sides is not None else np.zeros(many, bool)
    return value, feature, place - lay.starts[feature], goes_left & np.isfinite(value)


def grow(bins, a, b, rule: Rule, columns, classes, seed: int, top: int = 1):
    """All nodes below and including ``top`` of the rows given, as a NODE array."""
    return grow_laid(Layout(bins), None, np.asarray(a, float), np.asarray(b, float), rule, columns, classes, seed, top)


def leaves_of(ids, n, a, b):
    nodes = np.zeros(len(ids), NODE)
    nodes["id"], nodes["n"], nodes["a"], nodes["b"], nodes["feature"] = ids, n, a, b, -1
    return nodes


def grow_laid(lay: Layout, rows, a, b, rule: Rule, columns, classes, seed: int, top: int = 1, values=None):
    """``grow`` of the rows numbered ``rows`` (None: all) of a layout; ``a`` and ``b``
    have a number for each of its rows, and ``values``, if given, gets each row's
    value in the tree.

    Nodes of many rows are judged by sums per bin, a level at a time, each with a
    list of its rows: of two children only the smaller one is summed, the other one
    is its parent less that.  Smaller nodes go on in ``grow_sorted``, some at a time,
    so that what a pass reads stays near the processor."""
    columns, (p, whole_size) = np.asarray(columns), lay.own.shape
    line, size = lay.own.ravel(), whole_size if rows is None else len(rows)
    mine = b if rows is None else picked_of(b, rows)
    weight = None if size and mine.min() == 1 == mine.max() else b
    depth = int(top).bit_length() - 1
    least = max(rule.min_split, 2 * rule.min_leaf, 2)
    out, small = [], []                 # small: (nodes, their rows) of a level

    def ended(ids, at, sizes):
        """Leaves: their rows stand one leaf after another."""
        start = np.cumsum(sizes) - sizes
        total = lambda v: np.add.reduceat(v if at is None else picked_of(v, at), start)
        nodes = leaves_of(ids, sizes, total(a), sizes if weight is None else total(b))
        out.append(nodes)
        if values is not None:
            values[slice(None) if at is None else at] = np.repeat(rule.value(nodes["a"], nodes["b"], classes), sizes)

    if not size or depth >= rule.max_depth or size < least or not lay.real:
        if size:
            ended([top], rows, np.array([size]))
        return out[0] if out else leaves_of([top], 0, 0.0, 0.0)
    ids, sizes = np.array([top], np.int64), np.array([size])
    if size < lay.least:
        small, ids = [(ids, [np.arange(size) if rows is None else rows], depth)], ids[:0]
    else:
        weights = Weights(a, weight, rows, mine, rule)
        sums = level_sums(lay.own, a, weight, rows, lay, sizes, weights)
    while len(ids):
        n, sa, sb = weights.read(sums)
        whole = (*(v[:, lay.all_rows].sum(axis=1) for v in (sa, sb)), sizes)
        gain, feature, place, goes_left = best_places(rule, classes, lay, (n, sa, sb), whole, ids, columns, seed, weights.half)
        cut = np.isfinite(gain)
        nodes = leaves_of(ids, sizes, *whole[:2])
        nodes["feature"][cut], nodes["bound"][cut], nodes["left_missing"][cut] = feature[cut], place[cut], goes_left[cut]
        out.append(nodes)
        depth += 1
        if not cut.all():
            stay = np.repeat(cut, sizes)
            if values is not None:
                values[np.flatnonzero(~stay) if rows is None else rows.compress(~stay)] = np.repeat(rule.value(*whole[:2], classes)[~cut], sizes[~cut])
            if not cut.any():
                break
            rows = np.flatnonzero(stay) if rows is None else rows.compress(stay)
        which = np.flatnonzero(cut)
        ids, sizes = ids[which], sizes[which]
        if rows is None:
            value = lay.own[feature[0]]
        else:
            value = picked_of(line, np.repeat(feature[which] * whole_size, sizes) + rows)
        go = value <= np.repeat(place[which].astype(np.uint8), sizes)
        if goes_left[which].any():
            go |= (value == MISSING) & np.repeat(goes_left[which], sizes)
        left, right, last = np.flatnonzero(go), np.flatnonzero(~go), np.cumsum(sizes)
        left_n = np.diff(np.searchsorted(left, last), prepend=0)
        sides = [left, right] if rows is None else [picked_of(rows, left), picked_of(rows, right)]
        # the children: left ones before right ones
        child, n, many = np.concatenate([2 * ids, 2 * ids + 1]), np.concatenate([left_n, sizes - left_n]), len(ids)
        parts = [part for side, k in zip(sides, (n[:many], n[many:])) for part in np.split(side, np.cumsum(k)[:-1])]
        is_end = (n < least) | (depth >= rule.max_depth)
        is_small, goes_on = ~is_end & (n < lay.least), ~is_end & (n >= lay.least)
        together = lambda which: np.concatenate([parts[k] for k in which])
        if is_end.any():
            which_ends = np.flatnonzero(is_end)
            ended(child[which_ends], together(which_ends), n[which_ends])
        if is_small.any():
            small.append((child[is_small], [parts[k] for k in np.flatnonzero(is_small)], depth))
        after = np.flatnonzero(goes_on)
        if not len(after):
            break
        pair = np.flatnonzero(goes_on[:many] | goes_on[many:])
        less = np.where(n[pair + many] < n[pair], pair + many, pair)
        found = level_sums(lay.own, a, weight, together(less), lay, n[less], weights)
        at = np.searchsorted(pair, after % many)
        is_less = (less[at] == after)[:, None]
        sums = [np.where(is_less, f[at], v[which[after % many]] - f[at]) for v, f in zip(sums, found)]
        ids, sizes, rows = child[after], n[after], together(after)
    held, many = [], 0
    pending = [(node, own_rows, level) for nodes, lists, level in small for node, own_rows in zip(nodes, lists)]
    for k, item in enumerate(pending):
        held.append(item)
        many += len(item[1])
        if many >= SORT_CELLS // max(p, 1) or len(held) == 255 or k == len(pending) - 1:
            picked = np.concatenate([t[1] for t in held])
            found, value = grow_sorted(np.stack([picked_of(lay.own[j], picked) for j in columns]), picked_of(a, picked), None if weight is None else picked_of(b, picked), rule, columns, classes, seed,
                                       np.array([t[0] for t in held], np.int64), np.repeat(np.arange(len(held)), [len(t[1]) for t in held]), np.array([t[2] for t in held]))
            out.append(found)
            if values is not None:
                values[picked] = value
            held, many = [], 0
    return np.concatenate(out)


def grow_sorted(own, a, b, rule: Rule, columns, classes, seed: int, ids, at, depths):
    """(all nodes below and including ``ids`` (at ``depths``), value per row) of rows
    laid out by feature, each of which stands at the node numbered ``at``.

    Rows stay sorted by node and bin for every feature, so a level costs a few
    passes over rows x features however many nodes it has."""
    p, size = own.shape
    has_missing = bool((own == MISSING).any())
    rows, order, out = np.arange(size), None, []
    line, own_base = own.ravel(), np.arange(p)[:, None] * size
    least = max(rule.min_split, 2 * rule.min_leaf, 2)
    spread = np.square(a) / (1.0 if b is None else np.maximum(b, 1e-300)) if rule.kind == "mean" else None
    node_of, value_of = np.empty(size, np.int32), np.zeros(size)
    while len(ids):
        many = len(ids)
        counts = np.bincount(at, minlength=many)
        nodes = leaves_of(ids, counts, np.bincount(at, a[rows], many), counts.astype(float) if b is None else np.bincount(at, b[rows], many))
        whole = (nodes["a"].copy(), nodes["b"].copy(), counts)
        value_of[rows] = picked_of(rule.value(*whole[:2], classes), at)
        open_ = (counts >= least) & (depths < rule.max_depth)
        if spread is not None:              # no split gains more than the spread within the node
            own_score = rule.score(whole[0], whole[1])
            open_ &= np.bincount(at, spread[rows], many) - own_score > 0.5 * rule.least(own_score)
        elif rule.kind != "newton":
            open_ &= (whole[0] > 0) & (whole[1] > 0)
        if not open_.any():
            out.append(nodes)
            break
        which = np.flatnonzero(open_)
        if len(which) < many:               # rows of finished nodes leave
            stay = picked_of(open_, at)
            rows, at = rows.compress(stay), (np.cumsum(open_) - 1).take(at.compress(stay))
        if order is None or len(which) < many:
            node_of[:] = -1
            node_of[rows] = at
        if order is None:
            if len(which) <= 255:
                key = (at.astype(np.uint16) << np.uint16(8)) | np.take(own, rows, axis=1)
                order = rows[np.argsort(key, axis=1, kind="stable")]
            else:
                order = rows[np.argsort(np.take(own, rows, axis=1), axis=1, kind="stable")]
                order = np.take_along_axis(order, np.argsort(node_of[order], axis=1, kind="stable"), axis=1)
        elif len(which) < many:
            order = order.ravel().compress(picked_of(node_of, order).ravel() >= 0).reshape(p, -1)
        whole = tuple(w[which] for w in whole)
        lengths = whole[2]
        start = np.cumsum(lengths) - lengths
        places = picked_of(line, order + own_base)

        def running(v):
            """Sums along each node."""
            c = np.cumsum(picked_of(v, order), axis=1)
            base = np.zeros((p, len(start)))
            base[:, 1:] = c[:, start[1:] - 1]
            return c - np.repeat(base, lengths, axis=1)

        la = running(a)
        n = np.arange(1, order.shape[1] + 1) - np.repeat(start, lengths)
        lb = np.broadcast_to(n.astype(float), la.shape) if b is None else running(b)
        ok = np.empty(places.shape, bool)
        ok[:, :-1] = places[:, 1:] != places[:, :-1]
        ok[:, start + lengths - 1] = False
        missing = None
        if has_missing:
            gone = places == MISSING
            if gone.any():
                ok &= ~gone
                total = lambda v: np.add.reduceat(v, start, axis=1)
                missing = (total(np.where(gone, a.take(order), 0.0)), total(gone.astype(float) if b is None else np.where(gone, b.take(order), 0.0)), total(gone.astype(np.int64)))
        gains = Gains(rule, classes, start, lengths)
        gain, feature, place, goes_left = gains.best(la, lb, n, whole, missing, ok, ids[which], columns, seed)
        cut = np.isfinite(gain)
        split = np.flatnonzero(cut)
        bound = np.zeros(len(which), np.int16)
        bound[split] = places[feature[split], place[split]]
        nodes["feature"][which[split]], nodes["bound"][which[split]], nodes["left_missing"][which[split]] = columns[feature[split]], bound[split], goes_left[split]
        out.append(nodes)
        splits = len(split)
        if not splits:
            break
        # each row's child, left ones before right ones; rows of unsplit nodes leave
        if splits < len(which):
            stay = picked_of(cut, at)
            rows, at = rows.compress(stay), at.compress(stay)
        value = picked_of(line, picked_of(feature * size, at) + rows)
        to_left = value <= picked_of(bound, at)
        if missing is not None:
            to_left |= (value == MISSING) & picked_of(goes_left, at)
        at = picked_of(np.cumsum(cut) - 1, at) + splits * ~to_left
        node_of[:] = -1
        node_of[rows] = at
        flat, key = order.ravel(), picked_of(node_of, order).ravel()
        order = np.concatenate([flat.compress((key >= 0) & (key < splits)).reshape(p, -1), flat.compress(key >= splits).reshape(p, -1)], axis=1)
        parents = which[split]
        ids, depths = np.concatenate([2 * ids[parents], 2 * ids[parents] + 1]), np.tile(depths[parents] + 1, 2)
    return np.concatenate(out), value_of


def split_of(counts, a, b, offsets, rule: Rule, columns, classes, seed: int, node: int):
    """(a NODE, rows of its left child) from a node's sums per bin (features one
    after another from ``offsets``, each with its missing bin last)."""
    found, left = split_sums(counts, a, b, offsets, rule, columns, classes, seed, node)
    return found, left[0]


def split_sums(counts, a, b, offsets, rule: Rule, columns, classes, seed: int, node: int):
    """As ``split_of``, with (rows, A, B) of the left child."""
    found, left_sums = np.zeros(1, NODE), (0, 0.0, 0.0)
    spans = [(offsets[c], offsets[c + 1] - 1) for c in columns]
    widest = max(e - s for s, e in spans)
    layer = lambda v: np.stack([np.pad(v[s:e], (0, widest - (e - s))) for s, e in spans])
    n, sa, sb = layer(counts), layer(a), layer(b)
    last = np.array([e for _, e in spans])
    missing = tuple(v[last][:, None] for v in (a, b, counts))
    s, e = spans[0]
    whole = tuple(np.array([v[s:e + 1].sum()]) for v in (a, b, counts))
    found["id"], found["n"], found["a"], found["b"], found["feature"] = node, whole[2], whole[0], whole[1], -1
    if node.bit_length() - 1 < rule.max_depth and whole[2][0] >= rule.min_split:
        gains = Gains(rule, classes, np.array([0]), np.array([widest]))
        gain, feature, place, left = gains.best(np.cumsum(sa, axis=1), np.cumsum(sb, axis=1), np.cumsum(n, axis=1), whole,
                                                missing if missing[2].any() else None, n > 0, [node], columns, seed)
        if np.isfinite(gain[0]):
            found["feature"], found["bound"], found["left_missing"] = columns[feature[0]], place[0], left[0]
            own = lambda v, gone: v[feature[0], :place[0] + 1].sum() + (gone[feature[0], 0] if left[0] else 0)
            left_sums = (int(own(n, missing[2])), float(own(sa, missing[0])), float(own(sb, missing[1])))
    return found, left_sums


def rebased(ids, top: int):
    """Heap numbers below node ``top`` as numbers below 1."""
    out = np.array(ids)
    for depth in range(UNLIMITED + 1):
        at = (ids >> depth) == top
        if at.any():
            out[at] = ids[at] - ((top - 1) << depth)
    return out


class Tree:
    """Nodes in an order of their own with child positions, ready to be walked."""

    def __init__(self, nodes, rule: Rule, classes=(1.0, 1.0)):
        nodes = nodes[np.argsort(nodes["id"])]
        self.n, self.value = nodes["n"], rule.value(nodes["a"], nodes["b"], classes)
        self.feature, self.bound, self.left_missing = nodes["feature"], nodes["bound"].astype(np.int32), nodes["left_missing"]
        self.left = np.searchsorted(nodes["id"], 2 * nodes["id"]).astype(np.int32)
        self.ids = nodes["id"]

    def step(self, bins, rows, at):
        """Children of nodes ``at`` for the rows numbered ``rows``."""
        value = picked_of(bins.ravel(), rows * bins.shape[1] + picked_of(self.feature, at))
        left = value <= picked_of(self.bound, at)
        gone = value == MISSING
        if gone.any():
            left = np.where(gone, picked_of(self.left_missing, at), left)
        return picked_of(self.left, at) + ~left

    def leaves(self, bins):
        """Position of every row's leaf."""
        at = np.zeros(len(bins), np.int64)
        rows = np.flatnonzero(self.feature[at] >= 0)
        while len(rows):
            now = self.step(bins, rows, picked_of(at, rows))
            at[rows] = now
            rows = rows.compress(picked_of(self.feature, now) >= 0)
        return at

    def moved(self, bins, starts):
        """Value of every row of ``bins`` laid out in one line, a row from each of
        ``starts`` on: all rows walk as deep as the tree is, leaves lead to themselves."""
        ends = self.feature < 0
        itself = np.arange(len(ends))
        feature, bound, left = np.where(ends, 0, self.feature).astype(np.int64), np.where(ends, MISSING, self.bound).astype(np.int16), np.where(ends, itself, self.left).astype(np.int64)
        sides = self.left_missing & ~ends
        at = np.zeros(len(starts), np.int64)
        for _ in range(int(self.ids.max()).bit_length() - 1):
            value = bins.take(starts + feature.take(at))
            right = value > bound.take(at)
            if sides.any():
                right &= ~((value == MISSING) & sides.take(at))
            at = left.take(at) + right
        return self.value.take(at)

    def variants(self, bins, depths, splits):
        """Value of every row for each (depth limit, min_samples_split): rows x depths x splits."""
        out = np.empty((len(bins), len(depths), len(splits)))
        for i, least in enumerate(splits):
            ends = (self.feature < 0) | (self.n < least)
            at, depth, rows = np.zeros(len(bins), np.int64), 0, np.flatnonzero(np.repeat(~ends[:1], len(bins)))
            for j in np.argsort(depths):
                while len(rows) and depth < depths[j]:
                    now = self.step(bins, rows, picked_of(at, rows))
                    at[rows] = now
                    rows = rows.compress(~picked_of(ends, now))
                    depth += 1
                out[:, j, i] = self.value[at]
        return out
