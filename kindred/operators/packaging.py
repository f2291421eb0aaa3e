"""The archive to hand in: both result files, the sources and the documents."""

from __future__ import annotations

from pathlib import Path
from zipfile import ZIP_DEFLATED, ZipFile


def build_archive(root: str, target: str, results: list[str], source_folder: str, documents: list[str]) -> list[str]:
    """Zip the results, all .py files of the source folder and the documents under their paths below root; FileNotFoundError if any lacks."""
    top = Path(root)
    for p in results:
        if not (top / p).is_file():
            raise FileNotFoundError(f"a result is missing: {p}")
    sources = sorted(p.relative_to(top).as_posix() for p in (top / source_folder).rglob("*.py"))
    if not sources:
        raise FileNotFoundError(f"no source files in {source_folder}")
    for p in documents:
        if not (top / p).is_file():
            raise FileNotFoundError(f"a document is missing: {p}")
    names = [*results, *sources, *documents]
    Path(target).parent.mkdir(parents=True, exist_ok=True)
    with ZipFile(target, "w", ZIP_DEFLATED) as z:
        for name in names:
            z.write(top / name, name)
    return names
