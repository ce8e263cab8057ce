"""Small comment tables and the draw in plain Python."""

import hashlib
import re

from ruleweave.defaults import EXAMPLE_COLUMNS, SEED
from ruleweave.sources.files import TEST_SCHEMA, TRAIN_SCHEMA


def py_draw(tag, *keys, seed=SEED):
    text = "|".join([tag, str(seed), *map(str, keys)])
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def comments(spark, rows, labelled=False):
    """Frame from dicts; columns that a dict lacks are missing."""
    schema = TRAIN_SCHEMA if labelled else TEST_SCHEMA
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def with_examples(row, p1=None, p2=None, n1=None, n2=None):
    return {**row, **dict(zip(EXAMPLE_COLUMNS, (p1, p2, n1, n2)))}


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def ancestors(df, mark):
    """For each plan node that shows ``mark``: the nodes above it up to the first join, in a plan without broadcasts or changes."""
    spark = df.sparkSession
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(re.match(r"[\s:|+\-]*(\*\(\d+\))?\s*", line)[0].split("*")[0]) for line in lines]
    found = []
    for i, line in enumerate(lines):
        if mark not in line:
            continue
        above, at = [], depth[i]
        for j in range(i - 1, -1, -1):
            if depth[j] < at:
                at = depth[j]
                if "Join" in lines[j]:
                    break
                above.append(lines[j])
        found.append(above)
    return found
