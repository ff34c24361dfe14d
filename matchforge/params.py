"""Fixed values that must equal the source pipeline's for the same results.

Fixed values (do not change):
  SNAPSHOT_AT_MS    = 600000   first per-player snapshot at or after ten minutes
  MIN_DURATION_MS   = 600000   matches shorter than this are dropped everywhere
  EVENT_CUTOFF_MS   = 600100   events count only when strictly before this offset
  MS_PER_MINUTE     = 60000
  BLUE_TEAM         = 100      winning-team code of positions 1..5
  RED_TEAM          = 200      winning-team code of positions 6..10
  TEAM_SIZE         = 5
  RANKED_SOLO_QUEUE = 420
  HOME_REGION       = 'Europe'   roster: home and current region
  BASIC_ROLES       = 1, 2, 3, 4, 5
  OUTCOME_DIM       = (0, 'loss'), (1, 'win')
  TUNE_C_GRID       = 0.0, 0.5, 1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 4.5
  TUNE_CANDIDATES   = 10, TUNE_FOLDS = 3, MAX_ITER = 10000
"""

from dataclasses import dataclass

SNAPSHOT_AT_MS = 600000
MIN_DURATION_MS = 600000
EVENT_CUTOFF_MS = 600100
MS_PER_MINUTE = 60000
BLUE_TEAM = 100
RED_TEAM = 200
TEAM_SIZE = 5
RANKED_SOLO_QUEUE = 420
HOME_REGION = "Europe"
BASIC_ROLES = (1, 2, 3, 4, 5)
OUTCOME_DIM = ((0, "loss"), (1, "win"))
TUNE_C_GRID = tuple(x / 2 for x in range(10))
TUNE_CANDIDATES = 10
TUNE_FOLDS = 3
MAX_ITER = 10000


@dataclass(frozen=True)
class Cutoffs:
    """The three separate time thresholds (they differ on purpose)."""

    snapshot_at: int = SNAPSHOT_AT_MS
    min_duration: int = MIN_DURATION_MS
    event_before: int = EVENT_CUTOFF_MS

    def scaled(self, factor: int) -> "Cutoffs":
        return Cutoffs(self.snapshot_at * factor, self.min_duration * factor,
                       self.event_before * factor)


DEFAULT_CUTOFFS = Cutoffs()
