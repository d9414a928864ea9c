"""Places that the tests of the corpus operators read."""

from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent.parent
DATA = "/root/testdata/sf0.001"
