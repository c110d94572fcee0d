"""Multi-table plans."""

from barfold.plans.update import refresh_stored, stored_return, update_all

__all__ = ["refresh_stored", "stored_return", "update_all"]
