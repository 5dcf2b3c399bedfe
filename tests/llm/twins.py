"""Pairs of unlike texts that sums of values times powers modulo 2**64 cannot tell apart."""


def twins(letters: int = 2048, a: str = "a", b: str = "b") -> tuple[str, str]:
    """The Thue-Morse word of a power of two of letters, and its complement."""
    bits = [i.bit_count() & 1 for i in range(letters)]
    return "".join((a, b)[x] for x in bits), "".join((b, a)[x] for x in bits)
