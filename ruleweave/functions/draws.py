"""Keyed pseudo-random draws.

A draw depends only on its tag, the seed and the row's own keys, so a sample is the same whatever the partitioning,
and a task that is run again after an executor is lost makes the same choices.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ruleweave.defaults import SEED

# 15 hex digits: the widest draw that stays positive in a bigint. Draws are reduced modulo pool sizes, so they must
# be far wider than any row count.
_HEX_DIGITS = 15
DRAW_BITS = 4 * _HEX_DIGITS


def draw(tag: str, *keys: Column | str, seed: int = SEED) -> Column:
    """Uniform bigint in [0, 2**60) for integer or string keys. Use one tag per use site."""
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    text = F.concat_ws("|", F.lit(tag), F.lit(str(seed)), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, _HEX_DIGITS), 16, 10).cast("bigint")


def draw_bucket(value: Column, bits: int) -> Column:
    """High bits of a draw; bucket order equals draw order."""
    return F.shiftright(value, DRAW_BITS - bits).cast("int")


# Half rounds of the network, and the places that a walk may pass outside its domain.
HALF_ROUNDS = 4
WALK = 64


def permuted(place: Column, n: Column, tag: str, *keys: Column | str, seed: int = SEED) -> Column:
    """A keyed bijection of 0 .. n-1: where ``place`` goes to. Other keys give another order, without a sort.

    A Feistel network on numbers of two digits: each half round adds a draw on one digit to the other one. The digits count to
    about the root of n, so the domain has fewer than root n + 1 numbers beyond n; from one of these the network is walked on until it
    falls below n. For n up to 3,844 that ends within ``WALK`` steps; for larger ones the chance that it does not is below 1e-100.
    """
    low = F.ceil(F.sqrt(n.cast("double"))).cast("bigint")
    high = F.floor((n + low - 1) / low).cast("bigint")
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]

    def half_round(sizes: Column, r: int):
        def body(d: Column) -> Column:
            size = sizes["high"] if r % 2 == 0 else sizes["low"]
            moved = (d["a"] + draw(tag, F.lit(r), *parts, d["b"], seed=seed)) % size
            return F.struct(d["b"].alias("a"), moved.alias("b"))

        return body

    def step(x: Column, sizes: Column) -> Column:
        state = F.struct(F.floor(x / sizes["low"]).cast("bigint").alias("a"), (x % sizes["low"]).alias("b"))
        for r in range(HALF_ROUNDS):
            # Bound by an array of one, so the digits are computed once; they change places in each half round.
            state = F.transform(F.array(state), half_round(sizes, r))[0]
        return F.transform(F.array(state), lambda d: d["a"] * sizes["low"] + d["b"])[0]

    def walk(x: Column, bounds: Column) -> Column:
        steps = F.sequence(F.lit(1), F.lit(WALK))
        on = F.aggregate(steps, x, lambda at, _: F.when(at < bounds["n"], at).otherwise(step(at, bounds)))
        return F.when(x < bounds["n"], x).otherwise(on)

    bounds = F.struct(n.cast("bigint").alias("n"), low.alias("low"), high.alias("high"))
    return F.transform(
        F.array(bounds), lambda s: F.transform(F.array(step(place.cast("bigint"), s)), lambda x: walk(x, s))[0]
    )[0]
