"""Texts shared by the tests of the llm operators."""

WORDS = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho "
         "sigma tau upsilon phi chi psi omega").split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


#: Texts every operator must take.
ODD_TEXTS = [None, "", " ", "\n\n", "a", "é　x\x0b y\t\tz\r\n", "word " * 5000, "x" * 30_000,
             "line one\nline one\n\nLine one \n"]
