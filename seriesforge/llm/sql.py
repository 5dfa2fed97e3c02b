"""DuckDB expressions that the SQL twins share."""


def crc32_sql(text: str) -> str:
    """Unsigned crc32 of an ASCII string expression, bit by bit; DuckDB has no such function."""
    bits = "list_reduce([xor(crc, byte)] || range(8), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = f"list_transform(string_split({text}, ''), lambda c: CASE WHEN c = '' THEN NULL ELSE ord(c)::BIGINT END)"
    return f"xor(list_reduce([4294967295::BIGINT] || list_filter({codes}, lambda c: c IS NOT NULL), lambda crc, byte: {bits}), 4294967295)"
