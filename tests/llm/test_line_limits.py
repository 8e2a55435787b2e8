"""The limit of a line's documents is the same on small and on large hosts."""

from parcelight.llm import common, quality_rules
from tests.llm.test_text_operators import by_id, frame


def _own(i):
    return " ".join(f"own{i}x{k}" for k in range(60))


def test_limit_does_not_grow_with_the_host(spark):
    common.prepared(spark)
    notice = " ".join(f"Notice{k}" for k in range(200))
    rows, spot = [], 0
    for host, others in (("hot", 6000), ("small", 40)):
        rows += [(spot + i, _own(spot + i), "en", host) for i in range(others)]
        spot += others
        rows += [(spot + i, f"{_own(spot + i)}\n{notice}", "en", host) for i in range(30)]
        spot += 30
    found = by_id(quality_rules.quality_rules(frame(spark, rows)))
    assert sorted(i for i, r in found.items() if r.depleted) == [*range(6000, 6030), *range(6070, 6100)]


def test_a_line_in_thousands_of_documents_of_a_hot_host(spark):
    rows = [(i, f"{_own(i)}\nread more about this on the next page of our site", "en", "hot") for i in range(3000)]
    found = by_id(quality_rules.quality_rules(frame(spark, rows)))
    assert all(r.n_boilerplate_words == 11 and r.n_boilerplate_lines == 1 and r.kept for r in found.values())


def test_copies_of_a_text_are_one_document(spark):
    rows = [(i, _own(0), "en", "a") for i in range(90)] + [(90 + i, _own(1 + i), "en", "a") for i in range(20)]
    found = by_id(quality_rules.quality_rules(frame(spark, rows)))
    assert all(r.kept and not r.depleted for r in found.values())
