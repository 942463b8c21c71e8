import pytest

from colloquy.config import Config, ensemble_route, merge_route


def test_steps():
    assert Config().runs("merge") and Config(steps=("merge",)).runs("merge") and not Config(steps=("merge",)).runs("slides")
    with pytest.raises(ValueError):
        Config(steps=("dance",))
    with pytest.raises(ValueError):
        Config(chunk_words=0)
    assert Config().skips(True) and not Config().skips(False) and Config(dry_run=True).skips(False) and not Config(skip_existing=False).skips(True)


def test_routes():
    assert ensemble_route(["small", "medium", "x"]) == ("resolve", "medium") and ensemble_route(["small"]) == ("none", "small")
    assert ensemble_route(["small", "large"], False) == ("base", "large") and ensemble_route([]) == ("none", None)
    assert merge_route(["a", "b"], "lex", "bracketed") == "structured:external" and merge_route(["a"], None, "bracketed") == "diarized"
    assert merge_route(["a", "b"], None, "bracketed") == "structured:diarized" and merge_route(["a", "b"]) == "flat" and merge_route(["a"]) == "none"
