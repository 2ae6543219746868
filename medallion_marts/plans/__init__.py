"""Jobs: events to entities, entities to marts, marts to views."""
