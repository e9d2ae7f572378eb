"""Checksums of substrings from running checksums of the whole.

The register of a CRC-32 is linear over GF(2): the register behind bytes A and then B is that
behind A, shifted by as many zero bytes as B has, XOR that of B alone. So one scan stores the
running register behind every byte, and the checksum of any substring is what two of them leave
when the first is shifted to the second's place and cancelled.
"""

from __future__ import annotations

import functools

import numpy as np

# Fixed values of the checksum: its reflected polynomial, and what the register starts and ends with.
_POLYNOMIAL = 0xEDB88320
_ONES = np.uint32(0xFFFFFFFF)
# The bytes of a lane: lanes are scanned side by side.
_LANE = 256


@functools.cache
def byte_table() -> np.ndarray:
    """The register behind each byte value, from an empty register."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & np.uint32(1), np.uint32(_POLYNOMIAL), np.uint32(0))
    return table


@functools.cache
def _shift_tables(power: int) -> np.ndarray:
    """What each byte of a register becomes behind 2 ** power zero bytes."""
    places = np.arange(256, dtype=np.uint32)
    parts = [places << np.uint32(8 * place) for place in range(4)]
    if power:
        return np.stack([_applied(power - 1, _applied(power - 1, part)) for part in parts])
    return np.stack([byte_table()[part & np.uint32(255)] ^ (part >> np.uint32(8)) for part in parts])


def _applied(power: int, registers: np.ndarray) -> np.ndarray:
    low, second, third, high = _shift_tables(power)
    mask = np.uint32(255)
    return (
        low[registers & mask]
        ^ second[(registers >> np.uint32(8)) & mask]
        ^ third[(registers >> np.uint32(16)) & mask]
        ^ high[registers >> np.uint32(24)]
    )


def shifted(registers: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """Each register behind its number of zero bytes."""
    registers = registers.copy()
    power = 0
    zeros = zeros.copy()
    while zeros.any():
        some = np.flatnonzero(zeros & 1)
        registers[some] = _applied(power, registers[some])
        zeros >>= 1
        power += 1
    return registers


def _scan(steps: np.ndarray, registers: np.ndarray, out: np.ndarray | None) -> np.ndarray:
    """The registers of all lanes behind their bytes; ``steps`` holds the lanes' bytes step by step."""
    table = byte_table()
    for number, step in enumerate(steps):
        registers = table[registers.astype(np.uint8) ^ step] ^ (registers >> np.uint32(8))
        if out is not None:
            out[number] = registers
    return registers


def running_crcs(data: np.ndarray) -> np.ndarray:
    """The register before the first byte (empty) and behind every byte of ``data``.

    Lanes of equal length are scanned side by side, first for what each adds; then every lane is
    scanned from the register that all before it leave.
    """
    if not len(data):
        return np.zeros(1, np.uint32)
    count = -(-len(data) // _LANE)
    lanes = np.zeros(count * _LANE, np.uint8)
    lanes[: len(data)] = data
    steps = np.ascontiguousarray(lanes.reshape(count, _LANE).T)
    # Inclusive prefixes of what the lanes add, by doubling.
    prefixes = _scan(steps, np.zeros(count, np.uint32), None)
    step = 1
    while step < count:
        earlier = shifted(prefixes[:-step], np.full(count - step, step * _LANE, np.int64))
        prefixes[step:] ^= earlier
        step *= 2
    out = np.empty((_LANE, count), np.uint32)
    _scan(steps, np.concatenate((np.zeros(1, np.uint32), prefixes[:-1])), out)
    return np.concatenate((np.zeros(1, np.uint32), out.T.ravel()[: len(data)]))


def substring_crcs(running: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The CRC-32 of every ``data[start:end]``, from the running registers of ``data`` alone."""
    return running[ends] ^ shifted(running[starts] ^ _ONES, ends - starts) ^ _ONES
