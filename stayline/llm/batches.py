"""Small helpers shared by the Arrow stages."""

import numpy as np

SLICE_BYTES = 2_000_000     # text handled at once inside a task


def text_slices(array, limit=SLICE_BYTES):
    """Consecutive zero-copy slices of an Arrow string array, each of at most
    ``limit`` bytes of text (a single longer text is a slice of its own)."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(array), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > limit:
            yield array.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(array) or not len(array):
        yield array.slice(start)


def spans_index(starts, lengths):
    """Flat positions of the concatenated ranges [start, start + length)."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total, dtype=np.int64)


class Flat:
    """Append-only store of integer lists: list i is data[start[i]:start[i]+length[i]]."""

    def __init__(self, dtype=np.int32):
        self.data, self.used = np.empty(1024, dtype), 0
        self.start, self.length, self.n = np.empty(1024, np.int64), np.empty(1024, np.int64), 0

    def append(self, data, lengths):
        need, many = self.used + len(data), self.n + len(lengths)
        if need > len(self.data):
            self.data = np.concatenate([self.data[: self.used], np.empty(max(need, self.used), self.data.dtype)])
        if many > len(self.start):
            grow = np.empty(max(many, self.n), np.int64)
            self.start, self.length = np.concatenate([self.start[: self.n], grow]), np.concatenate([self.length[: self.n], grow])
        self.data[self.used:need] = data
        self.length[self.n:many] = lengths
        self.start[self.n:many] = self.used + np.cumsum(lengths) - lengths
        self.used, self.n = need, many

    def gather(self, which):
        """(concatenated lists of ``which``, length of each)."""
        lengths = self.length[which]
        return self.data[spans_index(self.start[which], lengths)], lengths


def segment_sums(values, lengths):
    """Sum of each consecutive segment; 0 for an empty one."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]
