"""Known secrets, and long pieces of them, taken out of texts."""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import REDACTED

SEED = 12


def _runs(text: str, secret: str, seeds: dict[str, list[int]], least: int) -> list[tuple[int, int, int]]:
    """Per place of the text the longest piece of the secret that begins there: (-length, its place in the secret, the place)."""
    out, size = [], len(secret)
    for at in range(len(text) - least + 1):
        best = (0, 0)
        for start in seeds.get(text[at : at + least], ()):
            end = least
            while start + end < size and text[at + end : at + end + 1] == secret[start + end]:
                end += 1
            best = max(best, (end, -start))
        if best[0]:
            out.append((-best[0], -best[1], at))
    return out


def scrubber(secret: str, least: int = SEED) -> Callable[[str], str]:
    """A function that replaces every piece of at least ``least`` characters of a secret, the longest first, also with white space between its characters."""
    seeds: dict[str, list[int]] = defaultdict(list)
    for i in range(len(secret) - least + 1):
        seeds[secret[i : i + least]].append(i)

    def run(text: str) -> str:
        solid = [i for i, c in enumerate(text) if not c.isspace()]
        heap = _runs("".join(text[i] for i in solid), secret, seeds, least)
        if not heap:
            return text
        heapq.heapify(heap)
        taken = bytearray(len(solid))
        found = []
        while heap:
            length, start, at = heapq.heappop(heap)
            length = -length
            free = next((k for k in range(length) if taken[at + k]), length)
            if free == length:
                taken[at : at + length] = b"\1" * length
                found.append((solid[at], solid[at + length - 1] + 1))
            elif free >= least:  # what a longer piece left of it
                heapq.heappush(heap, (-free, start, at))
        out, done = [], 0
        for a, z in sorted(found):
            out += [text[done:a], REDACTED]
            done = z
        return "".join(out) + text[done:]

    return run


def scrub(text: Column, secrets: list[str], least: int = SEED) -> Column:
    """text without the secrets and all pieces of at least ``least`` characters, also where white space was put between characters.

    Shorter secrets are left alone: they would eat ordinary prose.  A secret
    holds no white space.  Pieces are found by an index of the secrets' seeds of
    ``least`` characters, so the cost grows with the text, not with the number
    of pieces; null stays null.
    """
    secrets = [s for s in secrets if s and len(s) >= least]
    if any(c.isspace() for s in secrets for c in s):
        raise ValueError("a secret must hold no white space")

    @F.arrow_udf(returnType=T.StringType())
    def clean(texts: pa.Array) -> pa.Array:
        runs, out = [scrubber(s, least) for s in secrets], []
        for t in texts.to_pylist():
            for run in runs if t else ():
                t = run(t)
            out.append(t)
        return pa.array(out, pa.string())

    return clean(text)
