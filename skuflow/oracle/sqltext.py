"""Small text helpers so that the oracle's arithmetic is spelled the same way everywhere."""


def dollars(cents: str) -> str:
    return f"(CAST({cents} AS DOUBLE) / 100)"


def rr(num: str, den: str, digits: int = 2) -> str:
    """num/den (integers) rounded half away from zero, exactly, as DOUBLE; NULL on den = 0."""
    s = 10 ** digits
    n = f"CAST({num} AS HUGEINT)"
    d = f"NULLIF(CAST({den} AS HUGEINT), 0)"
    return (f"(CAST(CASE WHEN {n} < 0 THEN -1 ELSE 1 END * ((2 * {s} * abs({n}) + {d}) // (2 * {d})) AS DOUBLE)"
            f" / {s})")


def pct(num: str, den: str, digits: int = 2) -> str:
    return rr(f"100 * CAST({num} AS HUGEINT)", den, digits)


def rhe(x: str, digits: int) -> str:
    """Half-to-even on the scaled double (pandas ``round``)."""
    return f"round_even({x}, {digits})"


def sdiv(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0))"


def i64(x: str) -> str:
    return f"CAST({x} AS BIGINT)"
