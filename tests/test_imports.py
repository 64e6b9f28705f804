"""Every module of the package can be imported, also those that a query imports only when it is called."""

import importlib
import pkgutil

import pytest

import textloom

MODULES = sorted(m.name for m in pkgutil.walk_packages(textloom.__path__, "textloom."))


@pytest.mark.parametrize("name", MODULES)
def test_module_imports(name):
    assert "textloom.llm.warc" in MODULES
    importlib.import_module(name)
