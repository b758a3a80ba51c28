"""A chi-square test against the uniform law, without SciPy."""


def chi_square_high(counts) -> bool:
    """True if the counts differ from uniform beyond about five standard deviations."""
    mean = counts.sum() / len(counts)
    x = ((counts - mean) ** 2 / mean).sum()
    free = len(counts) - 1
    return x > free + 5 * (2 * free) ** 0.5
