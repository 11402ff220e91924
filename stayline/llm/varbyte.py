"""Byte-aligned variable-length integers with separate control bytes."""

import numpy as np

from .batches import segment_sums

MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], "<u4")
LENGTHS = np.stack([(np.arange(256) >> (2 * k)) & 3 for k in range(4)], axis=1).astype(np.int8)     # by control byte


def used_slots(lengths, groups):
    """Which of the slots, four to a control byte, hold a rank: all but the last ones of a document."""
    used, ends, spare = np.ones(int(groups.sum()) * 4, bool), 4 * np.cumsum(groups), 4 * groups - lengths
    for k in range(1, 4):
        used[ends[spare >= k] - k] = False
    return used


def pack(ranks, lengths):
    """(control, data, control bytes per document, data bytes per document)."""
    size = 1 + (ranks > 0xFF).view(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    groups = (lengths + 3) // 4
    slots = np.zeros(int(groups.sum()) * 4, np.uint8)
    slots[used_slots(lengths, groups)] = size - 1
    four = slots.view("<u4")
    control = (four | four >> 6 | four >> 12 | four >> 18).astype(np.uint8)      # the low two bits of four bytes side by side
    data = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)[np.arange(4, dtype=np.uint8) < size[:, None]]
    return control, data, groups, segment_sums(size, lengths)


def unpack(control, data, lengths):
    """Ranks of a block."""
    groups = (lengths + 3) // 4
    size = LENGTHS[control].ravel()[used_slots(lengths, groups)] + 1
    at = np.cumsum(size, dtype=np.int64) - size
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    windows = np.ndarray(len(data), "<u4", padded, strides=(1,))     # the four bytes from every place on
    return (windows[at] & MASKS[size]).astype(np.int64)
