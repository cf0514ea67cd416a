"""Inputs: domain configuration, dataset files, samples, earlier output."""
