"""Functions for transform templates that Spark SQL does not already offer."""

from specflow.functions.masking import (
    mask_first_n,
    mask_last_n,
    mask_show_first_n,
    mask_show_last_n,
    register_masks,
)
from specflow.functions.templates import expand, is_repeatable

__all__ = [
    "expand",
    "is_repeatable",
    "mask_first_n",
    "mask_last_n",
    "mask_show_first_n",
    "mask_show_last_n",
    "register_masks",
]
