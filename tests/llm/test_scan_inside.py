from types import SimpleNamespace

from pagewright.llm import scan


def test_page_numbers_inside_a_text_are_found():
    quiet = SimpleNamespace(titles=frozenset(), misread=lambda text: False)
    flag = lambda *lines: scan._flag(quiet, "\n".join(lines))
    assert flag("one page", "- 12 -", "the next page") and flag("one page", " [7] ", "the next") is bool(scan.furniture(["one page", " [7] ", "the next"]))
    assert flag("one page", "WATER LEVELS. 12", "the next page")
    for lines in (["a", "b 12", "c"], ["a", "In May. 12", "c"], ["a", "(3)", "c"], ["a", "12", "c"]):
        assert flag(*lines) == bool(scan.furniture(lines))
