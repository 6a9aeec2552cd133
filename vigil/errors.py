"""Exception types raised by argument and schema guards (before any job runs)."""


class ContractError(ValueError):
    """A frame violates the feature contract (missing/extra column, dtype, null)."""


class BatchError(ValueError):
    """A batch cannot be scored (for example it lacks the row key)."""


class SeedContractError(ValueError):
    """A saved model deviates from the expected production feature contract."""
