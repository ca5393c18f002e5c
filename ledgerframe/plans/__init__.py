"""Named analytics and load jobs; each public function is one registered query."""
