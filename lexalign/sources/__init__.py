"""Readers and writers."""

from lexalign.sources.readers import *  # noqa: F403
from lexalign.sources.writers import *  # noqa: F403
