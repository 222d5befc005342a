"""Short forms used in the SQL texts."""


def d(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def s(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def dec(x: str, scale: int = 2) -> str:
    return f"CAST({x} AS DECIMAL(18,{scale}))"


def r2(x: str) -> str:
    """Half up to cents."""
    return f"(floor({d(x)} * 100e0 + 0.5e0) / 100e0)"


def cents(x: str) -> str:
    return dec(r2(x))


def pct(a: str, b: str) -> str:
    return f"(CASE WHEN {b} > 0 THEN {d(a)} / {d(b)} * 100 ELSE 0e0 END)"


def fixed(x: str, n: int) -> str:
    """Fixed decimals of the exact binary value, ties away from zero."""
    p, q = f"{float(2 ** (n + 1))}e0", f"{float(10**n)}e0"
    return (
        f"(CASE WHEN ({x}) * {p} = floor(({x}) * {p}) THEN sign({x}) * floor(abs({x}) * {q} + 0.5e0) / {q} "
        f"ELSE CAST(printf('%.{n}f', {x}) AS DOUBLE) END + 0e0)"
    )


def zone(m: str) -> str:
    return f"(CASE WHEN {m} >= 75 THEN 'green' WHEN {m} >= 65 THEN 'yellow' ELSE 'red' END)"


def tier(m: str, high: int, mid: int, op: str = ">=") -> str:
    return f"(CASE WHEN {m} {op} {high} THEN 'high' WHEN {m} {op} {mid} THEN 'mid' ELSE 'low' END)"


AS_OF = "DATE '2001-08-01'"
