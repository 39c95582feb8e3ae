"""The time at which the jobs under test run."""

from __future__ import annotations

from datetime import datetime

NOW = datetime(2024, 1, 8, 11, 34, 23)
