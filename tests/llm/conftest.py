import pytest

WORDS = "the of and to in that is was for on with as by this from river stone cloud maple amber violet copper".split()


def prose(seed, n):
    """n words without chance, the same on every run."""
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 8) % len(WORDS)] + str((x >> 16) % 97))
    return " ".join(out)


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty, blank, very long, repeated and near-equal texts, with extra columns whose names clash."""
    base = prose(1, 60)
    near = base.split()
    near[30] = "changed"
    texts = [
        None, "", " \t\n ", "a", "Hello wörld's <|endoftext|> x 12.5", base, base, " ".join(near), base.upper(), base + "\n" + base, prose(2, 30000),
        "x" * 20000, "Σίσυφος ΑΣ İ ﬁ ́a 漢字 🙂", "line one is here\nline one is here\n\nline two is here", "same words here now ok\nok now here words same", None,
    ]
    rows = [(k, t, "en" if k % 2 else None, None if k == 3 else f"s{k % 3}", 7, b"d", "label", 1) for k, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, "no id at all", "en", "s1", 0, b"", "x", 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, digest binary, label string, n int")


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
