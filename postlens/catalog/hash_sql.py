"""The hash of the feature buckets, in SQL."""

from __future__ import annotations

_MASK = "4294967295"


def _mixed_sql(k: str) -> str:
    first = f"(({k}) * 3432918353::UBIGINT) & {_MASK}"
    turned = f"((({first}) << 15) | (({first}) >> 17)) & {_MASK}"
    return f"((({turned}) * 461845907::UBIGINT) & {_MASK})"


def bucket_sql(term: str, buckets: int = 20_000) -> str:
    """The bucket of a term: MurmurHash3 (32 bits, seed 42) of its bytes, as a signed number, by the number of buckets."""
    h = f"hex(encode({term}))"
    size = f"(length({h}) // 2)"

    def little(at: str, n: int) -> str:
        return "CAST('0x' || " + " || ".join(f"substr({h}, {at} + {2 * i}, 2)" for i in reversed(range(n))) + " AS UBIGINT)"

    blocks = f"list_transform(range(0, {size} // 4), lambda i: {little('8 * i + 1', 4)})"
    step = _mixed_sql("k")
    turned = f"((xor(s, {step}) << 13) | (xor(s, {step}) >> 19)) & {_MASK}"
    body = f"list_reduce(list_prepend(42::UBIGINT, {blocks}), lambda s, k: ((({turned}) * 5 + 3864292196::UBIGINT) & {_MASK}))"
    start = f"({size} // 4 * 8 + 1)"
    tail = f"CASE {size} % 4 WHEN 0 THEN 0::UBIGINT " + " ".join(f"WHEN {n} THEN {little(start, n)}" for n in (1, 2, 3)) + " END"
    ended = f"xor(xor({body}, {_mixed_sql(tail)}), {size}::UBIGINT)"
    # The last scrambling, each step on the value before it.
    last = f"list_reduce([{ended}, 16, 2246822507, 13, 3266489909, 16]::UBIGINT[], lambda x, y: CASE WHEN y < 32 THEN xor(x, x >> y) ELSE (x * y) & {_MASK} END)"
    return f"list_transform([{last}], lambda v: ((v::BIGINT - CASE WHEN v >= 2147483648 THEN 4294967296 ELSE 0 END) % {buckets} + {buckets}) % {buckets})[1]"
