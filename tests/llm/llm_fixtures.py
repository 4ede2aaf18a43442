WORDS = ["ab", "cde", "the", "of", "é", "naïve", "x1", "zz", "longerword", "and"]


def prose(rng, n, words=None):
    return " ".join(rng.choice(words or WORDS) + (str(rng.randint(0, 400)) if rng.random() < .7 else "")
                    for _ in range(n))
