"""Column-expression helpers; everything here stays inside whole-stage codegen."""

from selfmend.functions.numeric import strict_double, fixed2_text
from selfmend.functions.rules import Free, OneOf, Range, RuleSet
from selfmend.functions.files import source_file_name, source_file_path

__all__ = ["strict_double", "fixed2_text", "Free", "OneOf", "Range", "RuleSet",
           "source_file_name", "source_file_path"]
