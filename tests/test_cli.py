"""The command line lists every registered query."""

from molarflow.__main__ import main
from molarflow.plans import REGISTRY


def test_list(capsys):
    assert main(["list"]) == 0
    out = capsys.readouterr().out
    assert all(name in out for name in REGISTRY)


def test_unknown_query(capsys):
    assert main(["run", "no_such_query"]) == 2
