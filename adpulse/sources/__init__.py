"""Where events come from: landing directories, tables, file streams."""
