"""Reading and writing: staged files, seeds, stored tables, test staging."""
