"""Staged tables by name, with some of them replaced."""


class Overlay:
    def __init__(self, base, **replaced):
        self._base, self._replaced = base, replaced

    def __getitem__(self, name):
        return self._replaced[name] if name in self._replaced else self._base[name]
