"""Table writers with schema rules, counted writes and materialisation."""
