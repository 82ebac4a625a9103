"""Draws that depend on a key and a seed only, by the generator of Python's standard library, which the engine has no built-in for."""

from __future__ import annotations

import hashlib
import random

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Part of signatures that are typed, the font of these, and how far others are turned at most, in degrees.
TYPED, TYPED_FONT, TURN = 0.70, "Typed Sans", 3.0
FONTS = ("Script One", "Script Two")
SIGNATURE = T.StructType([T.StructField("mode", T.StringType()), T.StructField("font", T.StringType()), T.StructField("rotation_deg", T.DoubleType())])


def generator(key: str, seed: int) -> random.Random:
    """The generator of a key: seeded by the seed and the first 64 bits of the key's SHA-256, combined bit by bit."""
    return random.Random(seed ^ int.from_bytes(hashlib.sha256(key.encode("utf-8")).digest()[:8], "big"))


def signature(key: Column, seed: int, fonts: tuple[str, ...] = FONTS, typed: float = TYPED, turn: float = TURN) -> Column:
    """struct(mode, font, rotation_deg) of a key's signature: typed for that part of keys, else handwritten in one of the fonts, turned by up to turn either way. Null for a null key."""

    def draw(k: str) -> tuple[str, str, float]:
        g = generator(k, seed)
        if g.random() < typed:
            return "typed", TYPED_FONT, 0.0
        return "handwritten", g.choice(fonts), g.uniform(-turn, turn)

    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(None, None, None) if k is None else draw(k) for k in s], columns=SIGNATURE.names)

    return F.pandas_udf(run, SIGNATURE)(key)
