"""Column-expression building blocks (all JVM-side, codegen friendly)."""

from affinity.functions.geo import great_circle_km, in_box, BOX_CONTIGUOUS  # noqa: F401
from affinity.functions.numeric import safe_ln, to_double  # noqa: F401
from affinity.functions.color import color_stop, color_position  # noqa: F401
