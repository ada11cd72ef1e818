"""Made-up prose for tests."""


def prose(rng, n):
    return " ".join("".join(rng.choice(["ka", "lo", "mi", "ste", "ron", "pu", "vel"]) for _ in range(rng.randint(1, 4))) for _ in range(n))
