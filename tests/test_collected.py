"""All test modules can be collected in one run, also those of equal names in different folders."""

import subprocess
import sys
from pathlib import Path

TESTS = Path(__file__).parent


def test_all_modules_are_collected():
    said = subprocess.run([sys.executable, "-m", "pytest", str(TESTS), "--collect-only", "-q"], cwd=TESTS.parent, capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stdout[-1000:]
