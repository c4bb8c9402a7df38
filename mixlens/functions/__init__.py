from .exprs import *  # noqa: F401,F403
from .joins import join_small, scalar_row  # noqa: F401
