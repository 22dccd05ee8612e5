"""Exact, reproducible, stratified train / validation / test split.

Sizes follow scikit-learn's ``train_test_split(..., stratify=y)`` applied twice
(test first, then validation out of the rest):

* ``n_test = ceil(test_size * n)``, ``n_train = n - n_test``;
* train rows per class = floor(count / n * n_train), plus one for the classes
  with the largest remainders until the total is reached (ties: lower class
  code first, where scikit-learn draws at random); the class rest is the test
  share.

Membership: inside each class rows are ordered by ``md5(seed|key)`` then key;
the first train quota is train, the next validation quota validation, the rest
test.  No row is ranked, sorted or shuffled for it: a part ends at one (hash, key)
of each class, its threshold, and these are found by selection when the split is
asked for.  A job counts rows by class and the first ``hex_digits`` of the hash
(combined before its shuffle); the driver receives classes x 16^hex_digits counts
at most, and so the quotas and the buckets in which the thresholds are.  Further
jobs count those few buckets by the next digits, until one holds a thousand rows
or fewer; a last one fetches these.  Then every row is compared with the two
thresholds of its class, which are literals, where it stands.  The input is read
once for each job, so it should be a written table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tutorlens.functions.lookup import CLASS_LABELS
from tutorlens.functions.rounding import round_half_even
from tutorlens.keys import K3

SPLITS = ("train", "validation", "test")


#: Rows of a bucket that the driver fetches to find a threshold.
CANDIDATES = 1000


def _largest_remainder(counts: dict, draws: int) -> dict:
    """Allocate ``draws`` over the classes in proportion to ``counts``; ties to the lower class."""
    total = float(sum(counts.values()))
    share = {c: float(n) / total * float(draws) for c, n in counts.items()}
    out = {c: math.floor(v) for c, v in share.items()}
    for c in sorted(counts, key=lambda c: (-(share[c] - out[c]), c))[: draws - sum(out.values())]:
        out[c] += 1
    return out


def class_quotas(counts: dict, test_size: float, val_size: float) -> dict:
    """(train, validation, test) rows of each class from the rows of each class."""
    total = sum(counts.values())
    rest = _largest_remainder(counts, total - math.ceil(float(test_size) * float(total)))
    left = sum(rest.values())
    val_ratio = float(val_size) / (1.0 - float(test_size))
    train = _largest_remainder(rest, left - math.ceil(val_ratio * float(left))) if left else rest
    return {c: (train[c], rest[c] - train[c], n - rest[c]) for c, n in counts.items()}


def stratified_split(
    df: DataFrame,
    label: str = "target",
    key: Sequence[str] = K3,
    test_size: float = 0.15,
    val_size: float = 0.15,
    seed: int = 42,
    classes: Sequence[int] = tuple(CLASS_LABELS),
    hex_digits: int = 3,
    output: str = "split",
) -> DataFrame:
    """Add ``output`` in {'train', 'validation', 'test'} to every row.

    ``key`` must identify a row (split before dropping the id).  ``classes``
    is the label domain; a missing or unknown label fails the job, which also
    bounds what the driver receives.
    """
    lab = f"`{label}`"
    domain = ", ".join(repr(c) for c in classes)
    message = f"stratified_split: label {label} missing or not in [{domain}]: "
    checked = df.withColumn(
        label,
        F.expr(
            f"CAST(IF({lab} IN ({domain}), {lab}, raise_error(concat('{message}', coalesce(CAST({lab} AS STRING), 'null')))) "
            f"AS {df.schema[label].dataType.simpleString()})"
        ),
    )
    keys = ", ".join(f"CAST(`{k}` AS STRING)" for k in key)
    hashed = f"md5(concat_ws('|', '{seed}', {keys}))"
    # the label comes from ``checked``, so a wrong one fails here
    x = checked.selectExpr(f"{lab} AS _y", f"{hashed} AS _h", *[f"`{k}` AS _k{i}" for i, k in enumerate(key)])

    def counts(rows: DataFrame, digits: int) -> dict:
        """{class: [(prefix, rows)]} in the order of the prefixes."""
        found = rows.groupBy("_y", F.substring("_h", 1, digits).alias("_p")).agg(F.count(F.lit(1)).alias("_n")).collect()
        out: dict = {}
        for r in sorted(found, key=lambda r: r["_p"]):
            out.setdefault(r["_y"], []).append((r["_p"], r["_n"]))
        return out

    first = counts(x, hex_digits)
    quotas = class_quotas({c: sum(n for _, n in found) for c, found in first.items()}, test_size, val_size) if first else {}
    # (class, part): the prefix of its threshold's bucket, the rows of the bucket and the threshold's rank among them
    ends = {}
    for c, (train, validation, _) in quotas.items():
        for part, rank in enumerate((train, train + validation)):
            if (end := _bucket_of(first[c], rank)) is not None:
                ends[c, part] = end
    digits = hex_digits
    while digits < 32 and (large := {end[0] for end in ends.values() if end[1] > CANDIDATES}):
        digits = min(32, digits + hex_digits)
        inner = counts(x.where(F.substring("_h", 1, digits - hex_digits).isin(sorted(large))), digits)
        for (c, part), (prefix, _, rank) in list(ends.items()):
            if prefix in large:
                ends[c, part] = _bucket_of([(p, n) for p, n in inner[c] if p.startswith(prefix)], rank)
    thresholds = {}
    if ends:
        wanted = " OR ".join(f"(_y = {c!r} AND startswith(_h, '{prefix}'))" for c, prefix in sorted({(c, end[0]) for (c, _), end in ends.items()}))
        rows = sorted(x.where(wanted).collect(), key=lambda r: (r["_h"], *r[2:]))
        for (c, part), (prefix, _, rank) in ends.items():
            thresholds[c, part] = [r for r in rows if r["_y"] == c and r["_h"].startswith(prefix)][rank]

    place = F.struct(F.expr(hashed), *[F.col(f"`{k}`") for k in key])
    split = F.lit(SPLITS[2])
    for part in (1, 0):
        # a class without this threshold has all its rows before it
        before = F.lit(True)
        for c in quotas:
            if (c, part) in thresholds:
                r = thresholds[c, part]
                end = F.struct(F.lit(r["_h"]), *[F.lit(r[f"_k{i}"]).cast(df.schema[k].dataType) for i, k in enumerate(key)])
                before = F.when(F.col(lab) == c, place < end).otherwise(before)
        split = F.when(before, SPLITS[part]).otherwise(split)
    return checked.select(*[f"`{c}`" for c in df.columns], split.alias(output))


def _bucket_of(found: list[tuple[str, int]], rank: int) -> tuple[str, int, int] | None:
    """The (prefix, rows) bucket that holds ``rank``, and the rank within it; None beyond the last row."""
    for prefix, n in found:
        if rank < n:
            return prefix, n, rank
        rank -= n
    return None


def split_sizes(split_df: DataFrame, output: str = "split") -> DataFrame:
    """Rows per split and percent of all rows (1 decimal, as printed)."""
    counts = split_df.groupBy(output).agg(F.count(F.lit(1)).alias("n_rows"))
    total = F.sum("n_rows").over(Window.partitionBy())
    return counts.select(
        output, "n_rows", round_half_even(F.col("n_rows") * 100.0 / total, 1).alias("percent")
    )


def split_class_shares(split_df: DataFrame, label: str = "target", output: str = "split") -> DataFrame:
    """Class counts and shares (3 decimals, half-even) inside each split."""
    from tutorlens.functions.lookup import map_lookup

    counts = split_df.groupBy(output, label).agg(F.count(F.lit(1)).alias("n_rows"))
    total = F.sum("n_rows").over(Window.partitionBy(output))
    return counts.select(
        output,
        map_lookup(label, CLASS_LABELS).alias("class_name"),
        "n_rows",
        round_half_even(F.col("n_rows") / total, 3).alias("share"),
    )
