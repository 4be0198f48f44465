"""Rating files for the tests of the text sources."""

from __future__ import annotations

from pathlib import Path


def write_rating_files(directory: Path, files: dict[str, str]) -> Path:
    """Write {file name: text} into `directory` and return it."""
    directory.mkdir(parents=True, exist_ok=True)
    for name, text in files.items():
        (directory / name).write_bytes(text.encode("utf-8"))
    return directory


def rating_file(movie_id: int, lines: list[str], newline: str = "\n") -> str:
    return newline.join([f"{movie_id}:", *lines]) + newline
