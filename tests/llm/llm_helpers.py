"""What several test files of the corpus operators share; fixtures are in ``conftest.py``."""

LOWER = {i: i + 32 for i in range(65, 91)}
