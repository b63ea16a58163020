"""Column functions over DNA strings; native but for the long approximate search."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

#: The adapter before the barcode, and how long barcode, molecule tag and the T run behind them are.
ADAPTER, BC, UMI, POLY_T = "CTACACGACGCTCTTCCGATCT", 16, 12, 10


def revcomp(seq: str | Column) -> Column:
    """Reverse complement; U counts as T, lower case is raised, all else is N."""
    seq = F.col(seq) if isinstance(seq, str) else seq
    return F.translate(F.reverse(F.regexp_replace(seq, "[^ACGTUacgtu]", "N")), "ACGTUacgtu", "TGCAATGCAA")


def infix_distance(query: str, target: str, most: int) -> Column:
    """Least edits that turn query into some substring of target, null beyond ``most``.

    Substrings whose length differs by more than ``most`` cost more, so only the others are
    compared; query deleted whole costs its length.
    """
    starts = f"sequence(1, length({target}))"
    sizes = f"sequence(greatest(1, length({query}) - {most}), length({query}) + {most})"
    cells = f"flatten(transform({starts}, s -> transform({sizes}, n -> if(s + n - 1 > length({target}), -1, levenshtein({query}, substr({target}, s, n), {most})))))"
    return F.expr(f"array_min(concat(filter({cells}, d -> d >= 0), if(length({query}) <= {most}, array(length({query})), cast(array() as array<int>))))")


def perfect_tag(seq: str, adapter: str = ADAPTER, bc_len: int = BC, umi_len: int = UMI, poly: int = POLY_T) -> list[Column]:
    """bc, umi, bu and is_perfect behind the first exact adapter; empty and false where it or a base is missing."""
    at = f"(instr({seq}, '{adapter}') + {len(adapter)})"
    whole = f"instr({seq}, '{adapter}') > 0 and length(substr({seq}, {at}, {bc_len + umi_len})) = {bc_len + umi_len}"
    cut = lambda start, n, name: F.expr(f"if({whole}, substr({seq}, {at} + {start}, {n}), '')").alias(name)
    perfect = F.expr(f"{whole} and substr({seq}, {at} + {bc_len + umi_len}, {poly}) = repeat('T', {poly})").alias("is_perfect")
    return [cut(0, bc_len, "bc"), cut(bc_len, umi_len, "umi"), cut(0, bc_len + umi_len + 5, "bu"), perfect]


def search(query: str, target: str, most: int) -> tuple[int, int]:
    """(distance, first best end, exclusive) of query within target by bit-parallel columns; (-1, -1) beyond ``most``."""
    n = len(query)
    if not n:
        return 0, 0
    masks: dict[str, int] = {}
    for i, c in enumerate(query):
        masks[c] = masks.get(c, 0) | 1 << i
    up, down, score, top, full = (1 << n) - 1, 0, n, 1 << n - 1, (1 << n) - 1
    best, end = (n, 0) if n <= most else (most + 1, -1)
    for j, c in enumerate(target, 1):
        match = masks.get(c, 0)
        diagonal = (((match & up) + up) ^ up) | match | down
        rise, fall = down | ~(diagonal | up) & full, up & diagonal
        score += bool(rise & top) - bool(fall & top)
        rise, fall = rise << 1 & full, fall << 1 & full  # a free start: the first row stays 0
        up, down = fall | ~(diagonal | rise) & full, rise & diagonal
        if score < best:
            best, end = score, j
    return (best, end) if end >= 0 else (-1, -1)


def tags(reads: DataFrame, seq: str = "seq", adapter: str = ADAPTER, bc_len: int = BC, umi_len: int = UMI, max_ed: int | None = None) -> DataFrame:
    """reads with bc, umi, bu, is_perfect; the adapter may have max_ed edits (3 in 10 by default).

    Rows with an exact adapter are cut natively; the others go through one Arrow pass.
    """
    most = int(0.3 * len(adapter)) if max_ed is None else max_ed
    exact = reads.where(F.instr(seq, adapter) > 0).select("*", *perfect_tag(seq, adapter, bc_len, umi_len))
    others = reads.where(F.coalesce(F.instr(seq, adapter), F.lit(0)) == 0)

    def cut(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            parts = []
            for s in frame[seq]:
                distance, end = search(adapter, s or "", most)
                tag = (s or "")[end : end + bc_len + umi_len + 5] if distance >= 0 else ""
                parts.append((tag[:bc_len], tag[bc_len : bc_len + umi_len], tag) if len(tag) >= bc_len + umi_len else ("", "", ""))
            frame["bc"], frame["umi"], frame["bu"] = zip(*parts) if parts else ([], [], [])
            yield frame.assign(is_perfect=False)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in reads.schema.fields) + ", bc string, umi string, bu string, is_perfect boolean"
    return exact.unionByName(others.mapInPandas(cut, schema))


def read_class(rt: str, tso: str, rt_back: str, tso_back: str, poly: str, poly_back: str) -> Column:
    """Artifact class of a read from the distances at which primers were found, null where not.

    rt: the 5' primer at the head; tso: the 3' primer at the tail; the two _back ones: the 5' primer
    in the complement of the tail and the 3' primer in that of the head. poly: is a T run found
    there. A proper read has both primers in one direction. With the 5' primer at both ends, the
    weaker one counts only with a T run beside it.
    """
    both = f"(({rt} is not null and {tso} is not null) or ({rt_back} is not null and {tso_back} is not null))"
    twice = f"(({rt} = {rt_back}) or ({rt} < {rt_back} and {poly_back}) or ({rt} > {rt_back} and {poly}))"
    return F.expr(
        f"case when {both} then 'Proper' when {twice} then 'RT-RT' when {rt} is not null or {rt_back} is not null then 'RT' "
        f"when {tso} is not null and {tso_back} is not null then 'TSO-TSO' when {tso} is not null or {tso_back} is not null then 'TSO' else 'No-RT-TSO' end"
    )


def located(query: str, most: int):
    """Arrow function of a sequence column: the distance of query within it, null beyond ``most``."""

    @F.pandas_udf(IntegerType())
    def distance(seqs: pd.Series) -> pd.Series:
        found = [search(query, s or "", most)[0] for s in seqs]
        return pd.Series([d if d >= 0 else None for d in found], dtype="Int32")

    return distance


def clip(cigar: str | Column, tail: bool = False) -> Column:
    """Soft-clipped bases at the head or tail of a CIGAR string."""
    cigar = F.col(cigar) if isinstance(cigar, str) else cigar
    return F.coalesce(F.nullif(F.regexp_extract(cigar, r"(\d+)S$" if tail else r"^(\d+)S", 1), F.lit("")).cast("int"), F.lit(0))


def head_bases(seq: str, cigar: str, reach: int = 200, inner: int = 50) -> Column:
    """Up to ``reach`` clipped bases before the alignment and ``inner`` after its start."""
    c = clip(cigar)
    start = F.greatest(F.lit(0), c - reach)
    return F.substring(F.col(seq), start + 1, F.least(c + inner, F.length(seq)) - start)


def tail_bases(seq: str, cigar: str, reach: int = 200, inner: int = 50) -> Column:
    """``inner`` bases before the alignment's end and up to ``reach`` clipped ones after it."""
    c, n = clip(cigar, tail=True), F.length(seq)
    start = F.greatest(n - c - inner, F.lit(0))
    return F.substring(F.col(seq), start + 1, F.when(c > reach, n - c + reach).otherwise(n) - start)


def is_reverse(seq: str = "seq", cigar: str = "cigar", flag: str = "flag", ts: str = "ts", run: int = 15) -> Column:
    """Does the transcript run against the read? By the ts tag and the flag; else by a T run at a
    clipped head (yes) or an A run at a clipped tail (no) with one edit at most; null if neither."""
    tagged = F.when(F.col(flag).bitwiseAND(16) > 0, F.col(ts) == "+").otherwise(F.col(ts) != "+")
    head, tail = F.substring(F.col(seq), F.lit(1), clip(cigar) + 50), F.substring(F.col(seq), F.greatest(F.length(seq) - clip(cigar, True) - 50, F.lit(0)) + 1, F.length(seq))
    t_run = (clip(cigar) > 0) & located("T" * run, 1)(head).isNotNull()
    a_run = (clip(cigar, True) > 0) & located("A" * run, 1)(tail).isNotNull()
    return F.when(F.col(ts).isNotNull(), tagged).when(t_run, F.lit(True)).when(a_run, F.lit(False))


def candidate(seq: str = "seq", cigar: str = "cigar", reverse: str = "reverse") -> Column:
    """The bases that hold the tags, read towards the transcript; empty if the strand is unknown."""
    return F.when(F.col(reverse), head_bases(seq, cigar)).when(~F.col(reverse), revcomp(tail_bases(seq, cigar))).otherwise("")
