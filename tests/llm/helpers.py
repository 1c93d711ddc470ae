"""Random texts and result rows for the tests of this folder."""

SMALL = "/root/testdata/sf0.001"

# words that mean nothing, so that random texts share few runs
POOL = [a + b + c for a in "bdfglmnprstvz" for b in "aeiou" for c in ("n", "s", "r", "lt", "mp")]


def sentence(rng, n):
    return " ".join(rng.choice(POOL) for _ in range(n))


def edited(rng, text, n):
    own = text.split(" ")
    for at in rng.sample(range(len(own)), n):
        own[at] = rng.choice(POOL)
    return " ".join(own)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)
