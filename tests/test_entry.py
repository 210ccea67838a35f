import runpy
import sys
from pathlib import Path

import pytest

ENTRY = str(Path(__file__).parents[1] / "__spark_entry__.py")


@pytest.mark.parametrize("absent", ["corpus_pipeline", "factprep.llm"])
def test_entry_works_without_the_corpus_operators(monkeypatch, absent):
    monkeypatch.delitem(sys.modules, "corpus_pipeline", raising=False)
    monkeypatch.setitem(sys.modules, absent, None)
    names = runpy.run_path(ENTRY)["queries"]()
    assert "flagship_clean_enrich" in names and "pipeline" not in names
    assert not any(n.startswith("op") and n[2].isdigit() for n in names)


def test_entry_does_not_hide_a_missing_package(monkeypatch, tmp_path):
    (tmp_path / "corpus_pipeline.py").write_text("import no_such_package")
    monkeypatch.syspath_prepend(str(tmp_path))
    monkeypatch.delitem(sys.modules, "corpus_pipeline", raising=False)
    with pytest.raises(ModuleNotFoundError, match="no_such_package"):
        runpy.run_path(ENTRY)
    sys.modules.pop("corpus_pipeline", None)
