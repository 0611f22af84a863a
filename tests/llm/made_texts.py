"""Texts made from a number."""

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omikron pi rho sigma tau ypsilon".split()


def prose(seed: int, n: int) -> str:
    """``n`` words that depend on the seed."""
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[x // 65536 % len(WORDS)] + str(x // 8192 % 50))
    return " ".join(out)
