"""Incremental layers: the file streams over bronze and over silver's changes."""

from tiersmith.streaming.gold import incremental_gold_sales
from tiersmith.streaming.incremental import incremental_silver, refresh_silver

__all__ = ["incremental_gold_sales", "incremental_silver", "refresh_silver"]
