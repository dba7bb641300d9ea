"""Word boundaries of a byte-level tokenizer, found on whole arrays of code points.

The splitting pattern of the public byte-level vocabularies is a small automaton
over classes of characters. A character is a *transition function* from state to
state; functions compose associatively, so the states after every character of a
long array come from a blocked prefix scan: blocks are composed side by side,
the block functions are chained, and the blocks are filled in. No regular
expression and no loop over characters is involved, and texts of any length cost
the same per character.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np

# character classes
S, T, R, E, V, M, L, D, LETTER, NUMBER, APOSTROPHE, OTHER, SPACE, BLANK, BREAK = range(15)
# states: what the last character belongs to
FRESH, WORD, DIGITS, MARKS, AFTER_SPACE, QUOTE, QUOTE_R, QUOTE_V, QUOTE_L, CONTRACTED = range(10)

# fixed values: the code points that are white space in Unicode, the plain space apart
WHITE = [*range(0x9, 0xE), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@cache
def class_table() -> np.ndarray:
    """The class of every code point."""
    kinds = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        major = unicodedata.category(chr(c))[0]
        if major == "L":
            kinds[c] = LETTER
        elif major == "N":
            kinds[c] = NUMBER
    for letter, kind in zip("strevmld", (S, T, R, E, V, M, L, D)):
        kinds[ord(letter)] = kind
    kinds[WHITE] = BLANK
    kinds[ord(" ")] = SPACE
    kinds[ord("'")] = APOSTROPHE
    return kinds


@cache
def transitions() -> np.ndarray:
    """``transitions()[class, state]`` is the state after a character of the class."""
    table = np.zeros((15, 10), np.uint8)
    table[: NUMBER] = WORD
    table[NUMBER], table[OTHER], table[SPACE], table[BLANK], table[BREAK] = DIGITS, MARKS, AFTER_SPACE, FRESH, FRESH
    table[APOSTROPHE] = QUOTE  # opens a contraction unless it goes on with a run of marks
    table[APOSTROPHE, [MARKS, QUOTE, AFTER_SPACE]] = MARKS
    table[[S, T, M, D], QUOTE] = CONTRACTED
    table[R, QUOTE], table[V, QUOTE], table[L, QUOTE] = QUOTE_R, QUOTE_V, QUOTE_L
    table[E, QUOTE_R] = table[E, QUOTE_V] = table[L, QUOTE_L] = CONTRACTED
    return table


def scan_states(kinds: np.ndarray, block: int = 256) -> np.ndarray:
    """The automaton's state after each character, by a blocked scan of transition functions."""
    n, table = len(kinds), transitions()
    if not n:
        return np.empty(0, np.uint8)
    rows = -(-n // block)
    padded = np.full(rows * block, BREAK, np.uint8)
    padded[:n] = kinds
    grid = np.ascontiguousarray(padded.reshape(rows, block).T)
    flat = table.ravel()
    composed = np.broadcast_to(np.arange(10, dtype=np.int16), (rows, 10))
    for step in grid:  # every block's function, composed side by side
        composed = flat[step.astype(np.int16)[:, None] * 10 + composed].astype(np.int16)
    entering = np.empty(rows, np.int16)
    state = FRESH
    for k, function in enumerate(composed.tolist()):  # the block functions, chained
        entering[k] = state
        state = function[state]
    out = np.empty((block, rows), np.uint8)
    current = entering
    for k, step in enumerate(grid):
        out[k] = flat[step.astype(np.int16) * 10 + current]
        current = out[k].astype(np.int16)
    return out.T.reshape(-1)[:n]


def starts(codes: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """True where a pre-token starts. ``breaks`` marks separators between texts; they start nothing."""
    kinds = class_table()[codes]
    kinds[breaks] = BREAK
    state = scan_states(kinds)
    group = np.full(len(kinds), 3, np.uint8)  # 0 letters, 1 numbers, 2 marks, 3 white space, 4 separator
    group[kinds < NUMBER] = 0
    group[kinds == NUMBER] = 1
    group[(kinds == APOSTROPHE) | (kinds == OTHER)] = 2
    group[kinds == BREAK] = 4
    n = len(kinds)
    before_group = np.full(n, 4, np.uint8)
    before_group[1:] = group[:-1]
    after_group = np.full(n, 4, np.uint8)
    after_group[:-1] = group[1:]
    before_state = np.full(n, FRESH, np.uint8)
    before_state[1:] = state[:-1]
    after_state = np.full(n, FRESH, np.uint8)
    after_state[:-1] = state[1:]
    solid = group < 3
    # a run of one group is one pre-token; a finished contraction ends it early
    out = solid & ((group != before_group) | (before_state == CONTRACTED))
    # letters of a contraction stay with its apostrophe
    out &= state != CONTRACTED
    out &= ~((state >= QUOTE_R) & (state <= QUOTE_L) & (after_state == CONTRACTED))
    # a plain space belongs to what follows
    out &= ~(solid & (before_state == AFTER_SPACE))
    white = group == 3
    # of white space before something solid the last character stands apart
    out |= white & ((before_group != 3) | (after_group < 3))
    return out
