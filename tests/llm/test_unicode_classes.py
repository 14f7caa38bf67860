"""op10: the Unicode classes are asked without a literal of all characters."""

from chargepulse.llm import bpe_fold


def test_classes_need_no_large_literal(spark, monkeypatch):
    lit, sizes = bpe_fold.F.lit, []

    def seen(value):
        sizes.append(len(value) if isinstance(value, str) else 0)
        return lit(value)

    monkeypatch.setattr(bpe_fold, "_ADDED", {})
    monkeypatch.setattr(bpe_fold.F, "lit", seen)
    for name in ("L", "N"):
        inside = bpe_fold.unicode_class(spark, name)
        assert inside.startswith(rf"\p{{{name}}}")
    assert max(sizes, default=0) < 1000


def test_java_classes_are_whole(spark):
    for name in ("L", "N"):
        java = bpe_fold._java_text(spark, name)
        assert list(java) == sorted(set(java))
        assert set(java) <= bpe_fold._library_has(name)
        assert len(java) > {"L": 130_000, "N": 1_700}[name]


def test_ranges():
    points = bpe_fold._code_points("abcxz\U0001F600\U0001F601")
    assert bpe_fold._ranges(points) == [(97, 99), (120, 120), (122, 122), (0x1F600, 0x1F601)]
    assert bpe_fold._ranges(points[:0]) == []
